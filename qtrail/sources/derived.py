"""Audit inputs derived from the driver's ``events`` table.

None of the driver tables is audit-shaped, so each ``events`` row is treated
as one query execution and split into the two logs the pipeline joins:

* a trail record unless ``event_id % 7 = 0`` (executions that left no start
  record, e.g. federated-identity sessions);
* a history row when ``event_id % 3 <> 0`` or the execution has no trail
  record — so every execution reaches at least one input and none is lost.

All derivations are deterministic column rules (see FIXTURES.md §5); the same
rules are written as DuckDB SQL in ``__spark_entry__.oracle_sql``. The work
grows linearly with ``events``: it is a projection plus filters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail import config as C

# Fixed values of the derived fixture (kept identical in the oracle SQL).
QUERY_TEXTS = (
    "SELECT * FROM sales.orders",
    "SELECT * FROM orders JOIN hr.people ON 1=1",
    "select * from `hr`.`people`",
    "SELECT 1",
    "SELECT * FROM orders",
    "SELECT o.id\nFROM sales.orders AS o\n\tJOIN lake.raw.clicks c ON c.id = o.id",
    "SELECT \"a b\", 'x' FROM \"hr\".\"people\" -- FROM finance.ledger",
    "INSERT INTO finance.ledger\r\nSELECT * FROM sales.orders WHERE note = 'say \"hi\" \\ {}, ok'",
    "SELECT * FROM Sales.Orders, hr.people",
)
RARE_EVERY = 1999  # of so many executions one names a ticket in its text
TIER_ROWS = (
    ("sales", "orders", "tier_2"),
    ("hr", "people", "tier_1"),
    ("default", "orders", "tier_3"),
    ("finance", "ledger", "tier_10"),
    ("lake", "raw", "tier_9"),
)
# Grants of every user: (catalog, db, tbl, the users it is for: id % n = 0).
GRANT_ROWS = (
    (None, "sales", "orders", 1),
    (None, "HR", "*", 2),
    ("lake", "raw", "clicks", 1),
    ("lake", "raw", "*", 3),
    (None, "raw", "clicks", 2),
    (None, "finance", "ledger", 1),
    (None, "finance", "budget", 1),
    (None, "*", "*", 7),
    ("other", "*", "*", 5),
)
IDENTITY_TYPES = ("Root", "IAMUser", "AssumedRole")
USER_AGENTS = ("sdk-python/1.26", "cli/2.15", "jdbc/2.1")
OTHER_EVENT_SOURCE = "storage.example.com"
TRAIL_DATABASE = "sales"
FAILED_REASON = "SYNTAX_ERROR: line 1:1"
CANCELLED_REASON = "Query cancelled by user"


@dataclass(frozen=True)
class AuditInputs:
    trail: DataFrame
    history: DataFrame
    tiers: DataFrame


def _case(key: Column, values) -> Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(key == i, F.lit(v)) if out is None else out.when(key == i, F.lit(v))
    return out


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = (spark.read.parquet(f"{sf_dir}/events.parquet")
          .select("event_id", "ts", "user_id", "event_type", "value"))
    eid, uid = F.col("event_id"), F.col("user_id")
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.concat(F.lit("q"), eid.cast("string")).alias("qid"),
        F.when(uid % 2 == 0, F.lit("us-east-1")).otherwise(F.lit("eu-west-1")).alias("region"),
        F.concat(F.lit("wg-"), (uid % 4).cast("string")).alias("wg"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        # The history job files some executions under the day their record
        # was closed: hours later, so evening ones fall on the next day (the
        # midnight case of the cross-day duplicate check).
        F.date_format(F.when(eid % 17 == 0, F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(8)))
                      .otherwise(F.col("ts")), "yyyy-MM-dd").alias("hday"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"),
        F.concat(_case(eid % len(QUERY_TEXTS), QUERY_TEXTS),
                 F.when(eid % RARE_EVERY == 7, F.concat(F.lit(" -- Ticket AUD-"), eid.cast("string"))).otherwise(F.lit(""))
                 ).alias("qt"),
    )


def derived_trail(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = (base if base is not None else _base(spark, sf_dir)).where(F.col("event_id") % 7 != 0)
    eid, uid = F.col("event_id"), F.col("user_id")
    # The trail delivers some records twice.
    b = b.withColumn("_copy", F.explode(F.when(eid % 29 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    arn = (F.when(uid == 11, F.lit(f"arn:x/{C.SELF_ROLE_MARKERS[0]}-R"))
           .when(uid == 12, F.lit(f"arn:x/{C.SELF_ROLE_MARKERS[1]}-R"))
           .when(uid % 50 == 13, F.lit(None).cast("string"))
           .otherwise(F.concat(F.lit("arn:u"), uid.cast("string"))))
    source_identity = F.when(uid % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("user"), uid.cast("string")))
    on_behalf = F.when(uid % 7 == 3, F.concat(F.lit("idc-"), uid.cast("string"))).otherwise(F.lit(None).cast("string"))
    shown_text = F.when(uid % 2 == 0, F.lit(C.REDACTED_QUERY_TEXT)).otherwise(F.col("qt"))
    request = F.to_json(F.struct(
        shown_text.alias("queryString"), F.struct(F.lit(TRAIL_DATABASE).alias("database")).alias("queryExecutionContext"),
        F.col("wg").alias("workGroup")))
    response = F.when(eid % 97 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit('{"queryExecutionId":"'), F.col("qid"), F.lit('"}')))
    identity = F.struct(
        _case(uid % 3, IDENTITY_TYPES).alias("type"),
        F.concat(F.lit("AID"), uid.cast("string")).alias("principalId"),
        arn.alias("arn"),
        F.lit("123456789012").alias("accountId"),
        F.lit(None).cast("string").alias("invokedBy"),
        F.concat(F.lit("AKIA"), uid.cast("string")).alias("accessKeyId"),
        F.concat(F.lit("name"), uid.cast("string")).alias("userName"),
        F.struct(source_identity.alias("sourceIdentity")).alias("sessionContext"),
        F.struct(on_behalf.alias("userId")).alias("onBehalfOf"),
    )
    return b.select(
        identity.alias("userIdentity"),
        F.col("iso").alias("eventTime"),
        F.when(eid % 11 == 0, F.lit(OTHER_EVENT_SOURCE)).otherwise(F.lit(C.QUERY_SERVICE_SOURCE)).alias("eventSource"),
        F.when(F.col("event_type") == "signup", F.lit("GetQueryExecution"))
         .otherwise(F.lit(C.START_EVENT_NAMES[0])).alias("eventName"),
        F.concat(F.lit("10.0."), (uid % 200).cast("string"), F.lit("."), (eid % 250).cast("string")).alias("sourceIPAddress"),
        # Some users run under two applications.
        _case((uid + F.when(uid % 8 == 1, eid % 2).otherwise(F.lit(0))) % 3, USER_AGENTS).alias("userAgent"),
        request.alias("requestParameters"),
        response.alias("responseElements"),
        "region", "day",
    )


def derived_history(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    eid = F.col("event_id")
    b = (base if base is not None else _base(spark, sf_dir)).where((eid % 3 != 0) | (eid % 7 == 0))
    status = (F.when(F.col("event_type") == "error", F.lit("FAILED"))
              .when(eid % 10 == 1, F.lit("CANCELLED"))
              .otherwise(F.lit("SUCCEEDED")))
    reason = (F.when(status == "FAILED", F.lit(FAILED_REASON))
              .when(status == "CANCELLED", F.lit(CANCELLED_REASON))
              .otherwise(F.lit("")))
    return b.select(
        F.col("qid").alias("query_id"),
        F.col("qt").alias("query"),
        F.floor(F.col("value") * F.lit(1e9)).cast(T.LongType()).alias("data_scanned"),
        status.alias("status"),
        reason.alias("state_change_reason"),
        F.col("iso").alias("submission_time"),
        "region", F.col("hday").alias("day"),
        F.col("wg").alias("workgroup"),
    )


def derived_tiers(spark: SparkSession) -> DataFrame:
    from qtrail.sources.tiers import tiers_from_rows
    return tiers_from_rows(spark, TIER_ROWS)


def derived_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grants of every user of the events, by name or by ARN."""
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct()
    uid = F.col("user_id")
    principal = F.concat(F.when(uid % 5 == 0, F.lit("arn:u")).otherwise(F.lit("user")), uid.cast("string"))
    rows = F.array(*[F.struct(F.lit(c).cast("string").alias("catalog"), F.lit(d).alias("db"), F.lit(t).alias("tbl"),
                              F.lit(n).alias("each")) for c, d, t, n in GRANT_ROWS])
    return (users.select("user_id", principal.alias("principal"), F.explode(rows).alias("g"))
            .where(uid % F.col("g.each") == 0)
            .select("principal", "g.catalog", "g.db", "g.tbl", F.lit("SELECT").alias("privileges")))


def audit_inputs(spark: SparkSession, sf_dir: str) -> AuditInputs:
    base = _base(spark, sf_dir)
    return AuditInputs(derived_trail(spark, sf_dir, base), derived_history(spark, sf_dir, base),
                       derived_tiers(spark))
