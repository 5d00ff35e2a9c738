"""Reports over the enriched events table.

Every report takes the events DataFrame and an optional predicate (see
``predicates.search_filter``) and returns a DataFrame; nothing is collected.
Aggregates are plain hash group-bys with map-side partial aggregation, so a
dominant user or workgroup is pre-combined in every task before the shuffle.
Top-k reports end in ``orderBy(..).limit(k)``, which Spark plans as a
per-partition top-k plus one bounded merge; ties are broken on the group keys
so the chosen rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail import config as C
from qtrail.functions import columns as X
from qtrail.functions import predicates as P


def _where(events: DataFrame, pred: Column | None) -> DataFrame:
    return events.where(pred) if pred is not None else events


def _count() -> Column:
    # count(1): Spark rejects count() with no argument.
    return F.count(F.lit(1))


def _flag_sum(status: str) -> Column:
    return F.sum(F.when(F.col("status") == status, 1).otherwise(0)).cast(T.LongType())


# A1
def events_count(events: DataFrame, from_day: str, to_day: str) -> DataFrame:
    return events.where(P.day_between(from_day, to_day)).agg(_count().alias("events"))


# A2
def summary(events: DataFrame, pred: Column | None = None, with_cost: bool = True) -> DataFrame:
    aggs = [
        _count().alias("total"),
        F.countDistinct("source_identity").alias("users"),
        F.countDistinct("workgroup").alias("workgroups"),
        _flag_sum("SUCCEEDED").alias("ok"),
        _flag_sum("FAILED").alias("fail"),
        _flag_sum("CANCELLED").alias("cancel"),
        X.gib(F.sum("data_scanned")).alias("gb"),
    ]
    if with_cost:
        aggs.append(X.money(F.sum("cost"), 4).alias("total_cost"))
    return _where(events, pred).agg(*aggs)


# A3
def queries_per_user_status(events: DataFrame, pred: Column | None = None,
                            k: int = C.TOP_USER_STATUS) -> DataFrame:
    g = _where(events, pred).groupBy(X.user_name().alias("user_name"), "status").agg(_count().alias("cnt"))
    return g.orderBy(F.desc("cnt"), F.asc_nulls_last("user_name"), F.asc_nulls_last("status")).limit(k)


# A4
def status_breakdown(events: DataFrame, pred: Column | None = None) -> DataFrame:
    return _where(events, pred).groupBy(X.status_or_unknown().alias("status")).agg(_count().alias("cnt"))


# A5 / L5
def queries_per_day(events: DataFrame, pred: Column | None = None, by_workgroup: bool = True) -> DataFrame:
    keys = ["day", "workgroup"] if by_workgroup else ["day"]
    return (_where(events, pred).groupBy(*keys).agg(_count().alias("cnt"))
            .orderBy(*[F.asc_nulls_last(k) for k in keys]))


# A6 -- newer variant orders by cost, the older one has no cost and orders by GB.
def workgroup_usage(events: DataFrame, pred: Column | None = None, with_cost: bool = True) -> DataFrame:
    aggs = [_count().alias("cnt"), X.gib(F.sum("data_scanned")).alias("gb")]
    if with_cost:
        aggs.append(X.money(F.sum("cost"), 4).alias("cost_usd"))
    g = _where(events, pred).where(F.col("workgroup").isNotNull()).groupBy("workgroup").agg(*aggs)
    return g.orderBy(F.desc("cost_usd" if with_cost else "gb"), F.asc("workgroup"))


# A7
def cost_per_user(events: DataFrame, pred: Column | None = None, k: int = C.TOP_USERS_BY_COST) -> DataFrame:
    g = _where(events, pred).groupBy(X.user_name().alias("user_name")).agg(
        _count().alias("queries"),
        X.gib(F.sum("data_scanned")).alias("gb"),
        X.money(F.sum("cost"), 4).alias("cost_usd"))
    return g.orderBy(F.desc_nulls_last("cost_usd"), F.asc_nulls_last("user_name")).limit(k)


# A8
def available(events: DataFrame, column: str, from_day: str, to_day: str) -> DataFrame:
    """Non-NULL users (``source_identity``) or workgroups in the range, most used first."""
    g = (events.where(P.day_between(from_day, to_day) & F.col(column).isNotNull())
         .groupBy(column).agg(_count().alias("queries")))
    return g.orderBy(F.desc("queries"), F.asc(column))


def available_users(events: DataFrame, from_day: str, to_day: str) -> DataFrame:
    return available(events, "source_identity", from_day, to_day)


def available_workgroups(events: DataFrame, from_day: str, to_day: str) -> DataFrame:
    return available(events, "workgroup", from_day, to_day)


# A9 / L4
def distinct_values(events: DataFrame, column: str) -> DataFrame:
    return events.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def distinct_users(events: DataFrame) -> DataFrame:
    return distinct_values(events, "source_identity")


def distinct_workgroups(events: DataFrame) -> DataFrame:
    return distinct_values(events, "workgroup")


# F8 + L1 + P11 + P12 -- the primary search view.
def user_search(events: DataFrame, pred: Column | None = None, limit: int = C.SEARCH_DEFAULT_LIMIT,
                with_cost: bool = True) -> DataFrame:
    cols = [
        "event_time", "source_identity", "workgroup", "status",
        X.query_preview().alias("query_text"),
        "database",
        X.mib("data_scanned").alias("data_mb"),
    ]
    if with_cost:
        cols.append(X.money("cost", 6).alias("cost_usd"))
    # query_id / region break ties among equal event times.
    return (_where(events, pred)
            .orderBy(F.desc_nulls_last("event_time"), F.asc_nulls_last("query_id"), F.asc("region"))
            .limit(limit).select(*cols))


# A10 -- over the already-limited search result. Grouping drops the NULL
# status (as the notebook's pandas group-by does); the total keeps every row.
def search_status_summary(search: DataFrame) -> DataFrame:
    aggs = [_count().alias("count"), F.sum("data_mb").cast(T.DecimalType(18, 2)).alias("total_mb")]
    if "cost_usd" in search.columns:
        aggs.append(F.sum("cost_usd").cast(T.DecimalType(18, 6)).alias("total_cost"))
    return search.where(F.col("status").isNotNull()).groupBy("status").agg(*aggs)


# S15 -- the (limited) search result as CSV with a header; one file, which is
# safe only because the input is already bounded by its LIMIT.
def export_csv(search: DataFrame, path: str) -> None:
    """One CSV file that reads back as written: quotes doubled, line breaks
    quoted, outer blanks kept."""
    (search.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def search_total_cost(search: DataFrame) -> DataFrame:
    return search.agg(F.sum("cost_usd").cast(T.DecimalType(28, 6)).alias("total_cost"))


# A11 + F9 -- ``user`` of the original text is ``source_identity``; GB are 10^9 bytes.
def top_users_by_scan(events: DataFrame, as_of: str, n_days: int = 7, k: int = C.TOP_USERS_BY_SCAN) -> DataFrame:
    g = (events.where(P.last_n_days(as_of, n_days))
         .groupBy(F.col("source_identity").alias("user"))
         .agg(X.decimal_gb(F.sum("data_scanned")).alias("total_data_scanned_gb")))
    return g.orderBy(F.desc_nulls_last("total_data_scanned_gb"), F.asc_nulls_last("user")).limit(k)


# A12
def adhoc_rollup(events: DataFrame, since_day: str, k: int = C.TOP_ADHOC) -> DataFrame:
    g = (events.where((F.col("day") >= F.lit(since_day)) & F.col("source_identity").isNotNull())
         .groupBy("source_identity", "workgroup", "status")
         .agg(_count().alias("cnt"),
              X.mib(F.sum("data_scanned")).alias("total_mb"),
              X.money(F.sum("cost"), 4).alias("total_cost_usd")))
    return g.orderBy(F.desc("cnt"), F.asc("source_identity"), F.asc_nulls_last("workgroup"),
                     F.asc_nulls_last("status")).limit(k)


# P13 + F10
def cost_listing(events: DataFrame) -> DataFrame:
    return events.where(P.non_empty("source_identity")).select(
        "source_identity", "data_scanned", X.money_text("cost").alias("cost"), "query")


# P14 -- the people-facing view.
AUDIT_REPORT_COLUMNS = (
    ("event_time", "Timestamp"), ("source_identity", "User"), ("on_behalf_of_user_id", "IDC User ID"),
    ("workgroup", "Workgroup"), ("query", "SQL Query"), ("database", "Database"), ("status", "Status"),
    (None, "Data Scanned (MB)"), ("cost", "Cost (USD)"), ("source_ip", "Source IP"), ("day", "Day"),
)


def audit_report(events: DataFrame) -> DataFrame:
    # bytes / 2^20 is exact in DOUBLE, as in the original view.
    mb = F.col("data_scanned").cast(T.DoubleType()) / F.lit(float(C.BYTES_PER_MIB))
    return events.select(*[(F.col(src) if src else mb).alias(name) for src, name in AUDIT_REPORT_COLUMNS])


# F12 / L3
def latest_events(events: DataFrame, k: int = C.LATEST_EVENTS, classified_only: bool = False) -> DataFrame:
    e = events.where(F.col("classification_tier").isNotNull()) if classified_only else events
    return e.orderBy(F.desc_nulls_last("event_time"), F.asc_nulls_last("query_id"), F.asc("region")).limit(k)


# S17 -- newest day present (a partition-column aggregate on Parquet).
def latest_day(events: DataFrame) -> DataFrame:
    return events.agg(F.max("day").alias("latest_day"))


# A15 (events job) -- one-row run report.
def events_run_report(events: DataFrame, from_day: str, to_day: str) -> DataFrame:
    return events_count(events, from_day, to_day).select(
        F.lit(from_day).alias("from_day"), F.lit(to_day).alias("to_day"), "events")


# P14 as a view, X6 -- user SQL over the events view.
def register_events_view(events: DataFrame, name: str = "events") -> None:
    events.createOrReplaceTempView(name)


def create_audit_report_view(events: DataFrame, name: str = "audit_report") -> None:
    audit_report(events).createOrReplaceTempView(name)


def adhoc_sql(events: DataFrame, sql: str, view: str = "events") -> DataFrame:
    """Run a user-supplied SELECT against the events registered as ``view``."""
    register_events_view(events, view)
    return events.sparkSession.sql(sql)


# T19 check -- a query kept on more than one day (e.g. started just before
# midnight in the trail, and listed as history-only on the next day).
def cross_day_duplicates(events: DataFrame) -> DataFrame:
    """Counts per (query_id, day) first: the second group-by starts from one
    row per id and day, and no distinct aggregate is left."""
    per_day = events.where(F.col("query_id").isNotNull()).groupBy("query_id", "day").agg(_count().alias("n"))
    g = per_day.groupBy("query_id").agg(_count().alias("days"), F.min("day").alias("first_day"),
                                        F.max("day").alias("last_day"), F.sum("n").alias("rows"))
    return g.where(F.col("days") > 1)
