"""
(the same results written as DuckDB SQL over the driver's tables).

The audit inputs (trail records, query history, tier map) are derived from
the driver's ``events`` table by fixed column rules (FIXTURES.md §5). Every
key runs the build over them on each call: reports that show no tier up to
the enriched rows, the others with classification as well.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from importlib.util import find_spec
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrail.config import QUERY_SERVICE_SOURCE, SELF_ROLE_MARKERS, TABLE_REF_PATTERN, AuditConfig
from qtrail.functions import predicates as P
from qtrail.functions.calendar import days_between
from qtrail.operators import classify as CL
from qtrail.operators import enrich as EN
from qtrail.operators import grants as G
from qtrail.operators import monitoring as MON
from qtrail.operators import reports as R
from qtrail.operators import textsearch as TS
from qtrail.operators.ingest import history_rows
from qtrail.plans import tables as TB
from qtrail.plans.events_job import build_events, run_range
from qtrail.plans.history_job import build_history
from qtrail.session import scratch_path
from qtrail.sources.derived import audit_inputs, derived_grants
from qtrail.sources.events import read_events, write_events
from qtrail.sources.executions import derived_executions
from qtrail.sources.history import read_history, write_history
from qtrail.sources.tiers import derived_tag_dump, tiers_from_tag_dump
from qtrail.sources.trail import read_trail, trail_quarantine, write_trail, write_trail_delivery

SMOKE_DIR = "/root/testdata/sf0.001"
# The range of the reports, the same in both engines.
FROM_DAY, TO_DAY = "2024-01-01", "2024-01-31"
AS_OF = "2024-01-31"
SEARCH_TEXT = "orders"
WG_FILTER = " WG-1 "


def _staging(spark: SparkSession, sf_dir: str, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    inp = audit_inputs(spark, sf_dir)
    return EN.staging(inp.trail, inp.history, cfg)


def _audit(spark: SparkSession, sf_dir: str, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    inp = audit_inputs(spark, sf_dir)
    return build_events(inp.trail, inp.history, inp.tiers, cfg)


def _days_of(df: DataFrame) -> tuple[str, str]:
    """First and last day of the data (one row)."""
    r = df.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    return r["lo"] or FROM_DAY, r["hi"] or TO_DAY


def _search_pred():
    return P.search_filter(FROM_DAY, TO_DAY, query_contains=SEARCH_TEXT)


def _range_pred():
    return P.search_filter(FROM_DAY, TO_DAY)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the full build (enrich + classify) feeding cost per user."""
    return R.cost_per_user(_audit(spark, SMOKE_DIR), _range_pred())


def _inputs_q(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inp = audit_inputs(spark, sf_dir)
        return fn(inp)
    return run


def _history_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "history")
    rows = history_rows(derived_executions(spark, sf_dir))
    write_history(rows, root)
    # Read back through the day-folder globs of every day of the data.
    return read_history(spark, root, days=days_between(*_days_of(rows)))


def _trail_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = audit_inputs(spark, sf_dir)
    root = scratch_path(spark, "trail")
    write_trail(inp.trail, root)
    return EN.staging(read_trail(spark, root, layout="hive"), inp.history)


def _events_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "events")
    write_events(_audit(spark, sf_dir), root)
    return read_events(spark, root)


def _backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = audit_inputs(spark, sf_dir)
    root = scratch_path(spark, "events")
    lo, hi = _days_of(inp.trail.select("day").union(inp.history.select("day")))
    run_range(spark, inp.trail, inp.history, inp.tiers, root, lo, hi)
    return read_events(spark, root)


# Days and region that the maintenance queries choose.
ONE_DAY, GONE_DAY, DROPPED_DAY, ONE_REGION = "2024-01-05", "2024-01-10", "2024-01-25", "us-east-1"
REPAIR_AS_OF, REPAIR_BACK = date(2024, 1, 31), 10
DELIVERED_DAYS = ("2024-01-08", "2024-01-09")
SEARCHED = {"user": "user18", "workgroup": "wg-2", "status": "SUCCEEDED"}
RARE_TEXT = "ticket aud-"
ADHOC = ("SELECT region, status, COUNT(*) AS cnt, CAST(SUM(data_scanned) AS BIGINT) AS bytes FROM events "
         "WHERE classification_tier = 'tier_1' GROUP BY region, status")


def _range_of(inp) -> tuple[str, str]:
    return _days_of(inp.trail.select("day").union(inp.history.select("day")))


def _catalog(spark: SparkSession) -> TB.TableSet:
    """Tables of a database of their own, over a scratch folder."""
    tables = TB.TableSet(f"qtrail_{uuid4().hex[:12]}", scratch_path(spark, "catalog"), {"events": "audit_events"})
    TB.init_tables(spark, tables)
    return tables


def _catalog_build(spark: SparkSession, sf_dir: str, tables: TB.TableSet) -> None:
    inp = audit_inputs(spark, sf_dir)
    lo, hi = _range_of(inp)
    # Twice: the second build switches every location of the first.
    for _ in range(2):
        run_range(spark, inp.trail, inp.history, inp.tiers, tables.folder("events"), lo, hi, table=tables.name("events"))


def _events_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _catalog(spark)
    _catalog_build(spark, sf_dir, tables)
    return spark.table(tables.name("events"))


def _catalog_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table of a built catalog, planned and counted, after it was made
    anew and its partitions registered from folder names."""
    tables = _catalog(spark)
    inp = audit_inputs(spark, sf_dir)
    lo, hi = _range_of(inp)
    write_history(inp.history, tables.folder("history"))
    write_trail_delivery(inp.trail, tables.folder("cloud_trail"))
    run_range(spark, inp.trail, inp.history, inp.tiers, tables.folder("events"), lo, hi)
    TB.init_tables(spark, tables, force=True)
    TB.add_trail_partitions(spark, tables, days_between(lo, hi), ["us-east-1", "eu-west-1"])
    kinds = {tables.name(k): k for k in TB.KINDS}
    counts = None
    for name, kind in kinds.items():
        n = spark.table(name).agg(F.lit(name).alias("table"), F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("rows"))
        counts = n if counts is None else counts.unionByName(n)
    report = TB.tables_report(spark, [*kinds, f"{tables.db}.absent"])
    return report.join(counts, "table", "left").select(F.coalesce("kind", F.lit("absent")).alias("kind"), "planned", "rows")


def _events_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by path, registered for some days of a region, one day dropped."""
    tables = _catalog(spark)
    write_events(_audit(spark, sf_dir), tables.folder("events"))
    TB.repair_events(spark, tables, REPAIR_BACK, [ONE_REGION], REPAIR_AS_OF)
    TB.drop_partitions(spark, tables.name("events"), [(ONE_REGION, DROPPED_DAY)])
    return spark.table(tables.name("events"))


def _backfill_shrunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second build, from inputs without a day, takes that day's partitions away."""
    inp = audit_inputs(spark, sf_dir)
    root = scratch_path(spark, "events")
    lo, hi = _range_of(inp)
    run_range(spark, inp.trail, inp.history, inp.tiers, root, lo, hi)
    left = F.col("day") != GONE_DAY
    run_range(spark, inp.trail.where(left), inp.history.where(left), inp.tiers, root, lo, hi)
    return read_events(spark, root)


def _trail_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery layout, many records per object, two of the days read back."""
    inp = audit_inputs(spark, sf_dir)
    root = scratch_path(spark, "delivery")
    write_trail_delivery(inp.trail, root)
    return EN.staging(read_trail(spark, root, days=DELIVERED_DAYS), inp.history, days=DELIVERED_DAYS)


def _trail_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable parts by day of a trail into which every 50th event has put
    a broken line; the records beside them are counted too."""
    inp = audit_inputs(spark, sf_dir)
    root = scratch_path(spark, "trail")
    write_trail(inp.trail, root)
    broken = (spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id % 50 = 0")
              .select(F.concat(F.lit('{"Records": [{"eventTime": "'), F.col("event_id").cast("string")).alias("value"),
                      F.lit("us-east-1").alias("region"), *[F.date_format("ts", p).alias(n) for n, p in
                                                            (("year", "yyyy"), ("month", "MM"), ("day", "dd"))]))
    broken.write.mode("append").partitionBy("region", "year", "month", "day").text(root)
    bad = trail_quarantine(spark, root, layout="hive").groupBy("day").agg(F.count(F.lit(1)).alias("bad"))
    good = read_trail(spark, root, layout="hive").groupBy("day").agg(F.count(F.lit(1)).alias("records"))
    return good.join(bad, "day", "full").select("day", "records", "bad")


def _history_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_history(derived_executions(spark, sf_dir), scratch_path(spark, "history"))


def _tag_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "tags")
    derived_tag_dump(spark, sf_dir).write.json(root)
    return tiers_from_tag_dump(spark, root)


def _latest_partition_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "events")
    write_events(_audit(spark, sf_dir), root)
    return spark.createDataFrame([(TB.latest_partition(spark, root),)], "latest_day string")


def _text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rare text, found through the trigram index of the files."""
    root = scratch_path(spark, "events")
    write_events(_audit(spark, sf_dir), root)
    TS.write_index(spark, root)
    return TS.events_containing(spark, root, RARE_TEXT)


def _heavy_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The redelivered ids joined by split rows."""
    inp = audit_inputs(spark, sf_dir)
    cfg = AuditConfig(heavy_rows=1)
    return EN.staging(inp.trail, inp.history, cfg, heavy=EN.heavy_keys(inp.trail, inp.history, cfg))


def _shared_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches stored by day, merged over the range, exact for those near a threshold."""
    events = _staging(spark, sf_dir)
    root = scratch_path(spark, "identity-sketches")
    MON.write_identity_sketches(events, root)
    return MON.shared_identities(events, MON.read_identity_sketches(spark, root, FROM_DAY, TO_DAY), FROM_DAY, TO_DAY)


def _csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    search = R.user_search(_staging(spark, sf_dir), _search_pred())
    root = scratch_path(spark, "export")
    R.export_csv(search, root)
    return (spark.read.schema(search.schema).option("header", True).option("escape", '"')
            .option("multiLine", True).csv(root))


# Queries of the training-data operators, where that subpackage is present.
if find_spec("qtrail.llm") is not None:
    from qtrail.llm import queries as _llm
else:
    _llm = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    strict = AuditConfig(strict_not_in=True)
    return {
        "events_pass1": _inputs_q(lambda i: EN.pass1(i.trail, i.history)),
        "events_history_only": _inputs_q(lambda i: EN.history_only(i.trail, i.history)),
        "events_history_only_strict": _inputs_q(lambda i: EN.history_only(i.trail, i.history, strict)),
        "events_enriched": lambda s, d: _staging(s, d),
        "events_enriched_strict": lambda s, d: _staging(s, d, strict),
        "events_heavy_split": _heavy_split,
        "null_arn_kept": lambda s, d: _staging(s, d, AuditConfig(keep_null_arn=True)),
        "region_filtered": _inputs_q(lambda i: EN.staging(i.trail, i.history, regions=[ONE_REGION])),
        "workgroup_filtered": lambda s, d: _staging(s, d, AuditConfig(workgroups_filter=WG_FILTER)),
        "table_refs": lambda s, d: CL.table_refs(_staging(s, d)),
        "classified_events": lambda s, d: _audit(s, d),
        "tier_counts": _inputs_q(lambda i: CL.tier_counts(EN.staging(i.trail, i.history), i.tiers)),
        "classified_only": lambda s, d: R.latest_events(_audit(s, d), classified_only=True),
        "latest_events": lambda s, d: R.latest_events(_audit(s, d)),
        "summary": lambda s, d: R.summary(_staging(s, d), _range_pred()),
        "queries_per_user_status": lambda s, d: R.queries_per_user_status(_staging(s, d), _range_pred()),
        "status_breakdown": lambda s, d: R.status_breakdown(_staging(s, d), _range_pred()),
        "queries_per_day": lambda s, d: R.queries_per_day(_staging(s, d), _range_pred()),
        "workgroup_usage": lambda s, d: R.workgroup_usage(_staging(s, d), _range_pred()),
        "cost_per_user": lambda s, d: R.cost_per_user(_staging(s, d), _range_pred()),
        "available_users": lambda s, d: R.available_users(_staging(s, d), FROM_DAY, TO_DAY),
        "available_workgroups": lambda s, d: R.available_workgroups(_staging(s, d), FROM_DAY, TO_DAY),
        "distinct_users": lambda s, d: R.distinct_users(_staging(s, d)),
        "distinct_workgroups": lambda s, d: R.distinct_workgroups(_staging(s, d)),
        "user_search": lambda s, d: R.user_search(_staging(s, d), _search_pred()),
        "search_status_summary": lambda s, d: R.search_status_summary(R.user_search(_staging(s, d), _search_pred())),
        "top_users_by_scan": lambda s, d: R.top_users_by_scan(_staging(s, d), AS_OF),
        "cost_listing": lambda s, d: R.cost_listing(_staging(s, d)),
        "audit_report": lambda s, d: R.audit_report(_staging(s, d)),
        "adhoc_rollup": lambda s, d: R.adhoc_rollup(_staging(s, d), FROM_DAY),
        "events_count": lambda s, d: R.events_count(_staging(s, d), FROM_DAY, TO_DAY),
        "latest_partition": lambda s, d: R.latest_day(_staging(s, d)),
        "run_report": lambda s, d: R.events_run_report(_staging(s, d), FROM_DAY, TO_DAY),
        "summary_no_cost": lambda s, d: R.summary(_staging(s, d), _range_pred(), with_cost=False),
        "workgroup_usage_by_gb": lambda s, d: R.workgroup_usage(_staging(s, d), _range_pred(), with_cost=False),
        "user_search_no_cost": lambda s, d: R.user_search(_staging(s, d), _search_pred(), with_cost=False),
        "search_total_cost": lambda s, d: R.search_total_cost(R.user_search(_staging(s, d), _search_pred())),
        "cross_day_duplicates": lambda s, d: R.cross_day_duplicates(_staging(s, d)),
        "history_day": lambda s, d: history_rows(derived_executions(s, d)),
        "history_scan": _history_scan,
        "trail_scan": _trail_scan,
        "events_sink_roundtrip": _events_roundtrip,
        "backfill": _backfill,
        "csv_export": _csv_export,
        "user_search_filtered": lambda s, d: R.user_search(_staging(s, d), P.search_filter(
            FROM_DAY, TO_DAY, query_contains=SEARCH_TEXT, **SEARCHED)),
        "text_search": _text_search,
        "adhoc_sql": lambda s, d: R.adhoc_sql(_audit(s, d), ADHOC),
        "history_one_day": lambda s, d: history_rows(derived_executions(s, d), days=[ONE_DAY]),
        "history_run_report": _history_report,
        "tag_source": _tag_source,
        "trail_delivered": _trail_delivered,
        "trail_quarantined": _trail_quarantined,
        "events_catalog": _events_catalog,
        "events_repaired": _events_repaired,
        "catalog_report": _catalog_report,
        "backfill_shrunk": _backfill_shrunk,
        "latest_partition_name": _latest_partition_name,
        "scan_scores": lambda s, d: MON.scan_scores(_staging(s, d), FROM_DAY, TO_DAY),
        "scan_anomalies": lambda s, d: MON.scan_anomalies(_staging(s, d), FROM_DAY, TO_DAY),
        "failure_rate": lambda s, d: MON.failure_rate(_staging(s, d), _range_pred()),
        "shared_identities": _shared_identities,
        "unused_grants": lambda s, d: G.unused_grants(derived_grants(s, d), _staging(s, d)),
        "grant_usage": lambda s, d: G.grant_usage(derived_grants(s, d), _staging(s, d)),
        **(_llm.queries() if _llm else {}),
    }


# ---------------------------------------------------------------------------
# DuckDB oracle. The CTE prefix re-derives the audit inputs with the same
# rules and then states the pipeline the way the original SQL does it: a LEFT
# JOIN for pass 1, NOT EXISTS / NOT IN for pass 2, UNION ALL, regex table
# references, MIN(tier) per (day, query_id), and a LEFT JOIN write-back.
# ---------------------------------------------------------------------------
_PATTERN = TABLE_REF_PATTERN.replace("(?iU)", "")  # DuckDB takes the flags as 'i'
REFS = G.QUALIFIED_REF_PATTERN.replace("(?iU)", "")
PART = G.NAME_PART
SRC = QUERY_SERVICE_SOURCE
ROLE1, ROLE2 = SELF_ROLE_MARKERS
_COST = "CAST(COALESCE(h.data_scanned, 0) / 1099511627776.0 * 5.00 AS DECIMAL(12,8))"
_ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def _prefix(wg_filter: str = "", arn_kept: bool = False) -> str:
    null_arn = " OR s.arn IS NULL" if arn_kept else ""
    wg1 = f"\n    AND lower(s.workgroup) LIKE '%{wg_filter}%'" if wg_filter else ""
    wg2 = f"\n    AND lower(h.workgroup) LIKE '%{wg_filter}%'" if wg_filter else ""
    return f"""
WITH ev AS (
  SELECT event_id, user_id, event_type, value, ts,
    'q' || CAST(event_id AS VARCHAR) AS qid,
    CASE WHEN user_id % 2 = 0 THEN 'us-east-1' ELSE 'eu-west-1' END AS region,
    'wg-' || CAST(user_id % 4 AS VARCHAR) AS wg,
    strftime(ts, '%Y-%m-%d') AS day,
    strftime(CASE WHEN event_id % 17 = 0 THEN ts + INTERVAL 8 HOUR ELSE ts END, '%Y-%m-%d') AS hday,
    strftime(ts, {_ISO}) AS iso,
    CASE event_id % 9 WHEN 0 THEN 'SELECT * FROM sales.orders'
      WHEN 1 THEN 'SELECT * FROM orders JOIN hr.people ON 1=1'
      WHEN 2 THEN 'select * from `hr`.`people`'
      WHEN 3 THEN 'SELECT 1' WHEN 4 THEN 'SELECT * FROM orders'
      WHEN 5 THEN 'SELECT o.id' || chr(10) || 'FROM sales.orders AS o' || chr(10) || chr(9)
        || 'JOIN lake.raw.clicks c ON c.id = o.id'
      WHEN 6 THEN 'SELECT "a b", ''x'' FROM "hr"."people" -- FROM finance.ledger'
      WHEN 7 THEN 'INSERT INTO finance.ledger' || chr(13) || chr(10)
        || 'SELECT * FROM sales.orders WHERE note = ''say "hi" ' || chr(92) || ' {{}}, ok'''
      ELSE 'SELECT * FROM Sales.Orders, hr.people' END
      || CASE WHEN event_id % 1999 = 7 THEN ' -- Ticket AUD-' || CAST(event_id AS VARCHAR) ELSE '' END AS qt
  FROM events),
delivered AS (SELECT * FROM ev WHERE event_id % 7 <> 0 UNION ALL SELECT * FROM ev WHERE event_id % 7 <> 0 AND event_id % 29 = 0),
trail AS (
  SELECT region, day, iso AS eventtime,
    CASE WHEN event_id % 11 = 0 THEN 'storage.example.com' ELSE '{SRC}' END AS eventsource,
    CASE WHEN event_type = 'signup' THEN 'GetQueryExecution' ELSE 'StartQueryExecution' END AS eventname,
    CASE user_id % 3 WHEN 0 THEN 'Root' WHEN 1 THEN 'IAMUser' ELSE 'AssumedRole' END AS user_identity_type,
    'AID' || CAST(user_id AS VARCHAR) AS principal,
    CASE WHEN user_id = 11 THEN 'arn:x/{ROLE1}-R' WHEN user_id = 12 THEN 'arn:x/{ROLE2}-R'
      WHEN user_id % 50 = 13 THEN NULL ELSE 'arn:u' || CAST(user_id AS VARCHAR) END AS arn,
    CASE WHEN user_id % 5 = 0 THEN NULL ELSE 'user' || CAST(user_id AS VARCHAR) END AS source_identity,
    CASE WHEN user_id % 7 = 3 THEN 'idc-' || CAST(user_id AS VARCHAR) END AS on_behalf_of_user_id,
    '10.0.' || CAST(user_id % 200 AS VARCHAR) || '.' || CAST(event_id % 250 AS VARCHAR) AS source_ip,
    CASE (user_id + CASE WHEN user_id % 8 = 1 THEN event_id % 2 ELSE 0 END) % 3 WHEN 0 THEN 'sdk-python/1.26' WHEN 1 THEN 'cli/2.15' ELSE 'jdbc/2.1' END AS user_agent,
    json_object('queryString', CASE WHEN user_id % 2 = 0 THEN '***OMITTED***' ELSE qt END,
      'queryExecutionContext', json_object('database', 'sales'), 'workGroup', wg) AS requestparameters,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE '{{"queryExecutionId":"' || qid || '"}}' END AS responseelements
  FROM delivered),
history AS (
  SELECT qid AS query_id, qt AS query, CAST(floor(value * 1e9) AS BIGINT) AS data_scanned,
    CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 10 = 1 THEN 'CANCELLED' ELSE 'SUCCEEDED' END AS status,
    CASE WHEN event_type = 'error' THEN 'SYNTAX_ERROR: line 1:1'
      WHEN event_id % 10 = 1 THEN 'Query cancelled by user' ELSE '' END AS state_change_reason,
    iso AS submission_time, region, hday AS day, wg AS workgroup
  FROM ev WHERE event_id % 3 <> 0 OR event_id % 7 = 0),
tiers AS (
  SELECT * FROM (VALUES ('sales', 'orders', 'tier_2'), ('hr', 'people', 'tier_1'),
    ('default', 'orders', 'tier_3'), ('finance', 'ledger', 'tier_10'), ('lake', 'raw', 'tier_9')) t(db, tbl, tier)),
starts AS (
  SELECT t.*, json_extract_string(responseelements, '$.queryExecutionId') AS query_id,
    json_extract_string(requestparameters, '$.queryString') AS query_string,
    json_extract_string(requestparameters, '$.queryExecutionContext.database') AS database,
    json_extract_string(requestparameters, '$.workGroup') AS workgroup
  FROM trail t
  WHERE eventsource = '{SRC}' AND eventname IN ('StartQueryExecution')),
pass1 AS (
  SELECT s.query_id, try_strptime(s.eventtime, {_ISO}) AS event_time,
    s.source_identity, s.on_behalf_of_user_id, s.user_identity_type,
    s.principal AS user_identity_principal, s.arn AS user_identity_arn, s.source_ip, s.user_agent,
    s.workgroup, COALESCE(h.query, NULLIF(s.query_string, '***OMITTED***')) AS query, s.database,
    h.status, h.state_change_reason, COALESCE(h.data_scanned, 0) AS data_scanned, {_COST} AS cost,
    s.region, s.day
  FROM starts s LEFT JOIN history h
    ON s.query_id = h.query_id AND h.day = s.day AND h.region = s.region
  WHERE (s.arn NOT LIKE '%{ROLE1}%' AND s.arn NOT LIKE '%{ROLE2}%'{null_arn})
    AND COALESCE(h.query, NULLIF(s.query_string, '***OMITTED***')) IS NOT NULL{wg1}),
hist_cols AS (
  SELECT h.query_id, try_strptime(h.submission_time, {_ISO}) AS event_time,
    CAST(NULL AS VARCHAR) AS source_identity, CAST(NULL AS VARCHAR) AS on_behalf_of_user_id,
    CAST(NULL AS VARCHAR) AS user_identity_type, CAST(NULL AS VARCHAR) AS user_identity_principal,
    CAST(NULL AS VARCHAR) AS user_identity_arn, CAST(NULL AS VARCHAR) AS source_ip,
    CAST(NULL AS VARCHAR) AS user_agent, h.workgroup, h.query, CAST(NULL AS VARCHAR) AS database,
    h.status, h.state_change_reason, COALESCE(h.data_scanned, 0) AS data_scanned, {_COST} AS cost,
    h.region, h.day
  FROM history h WHERE h.query IS NOT NULL{wg2}),
hist_only AS (
  SELECT * FROM hist_cols h WHERE NOT EXISTS (
    SELECT 1 FROM starts s WHERE s.region = h.region AND s.day = h.day AND s.query_id = h.query_id)),
hist_only_strict AS (
  SELECT * FROM hist_cols h WHERE h.query_id NOT IN (
    SELECT s.query_id FROM starts s WHERE s.region = h.region AND s.day = h.day)),
staging AS (SELECT * FROM pass1 UNION ALL SELECT * FROM hist_only),
refs_raw AS (
  SELECT day, query_id, COALESCE(NULLIF(database, ''), 'default') AS dbf,
    unnest(regexp_extract_all(query, '{_PATTERN}', 1, 'i')) AS g1,
    unnest(regexp_extract_all(query, '{_PATTERN}', 2, 'i')) AS g2
  FROM staging WHERE query IS NOT NULL),
refs AS (
  SELECT DISTINCT day, query_id,
    CASE WHEN COALESCE(g2, '') = '' THEN dbf ELSE g1 END AS db,
    CASE WHEN COALESCE(g2, '') = '' THEN g1 ELSE g2 END AS tbl
  FROM refs_raw),
best AS (
  SELECT r.day, r.query_id, MIN(t.tier) AS classification_tier
  FROM refs r JOIN tiers t ON r.db = t.db AND r.tbl = t.tbl GROUP BY r.day, r.query_id),
audit AS (
  SELECT st.query_id, st.event_time, st.source_identity, st.on_behalf_of_user_id, st.user_identity_type,
    st.user_identity_principal, st.user_identity_arn, st.source_ip, st.user_agent, st.workgroup, st.query,
    st.database, st.status, st.state_change_reason, st.data_scanned, st.cost, b.classification_tier,
    st.region, st.day
  FROM staging st LEFT JOIN best b ON b.day = st.day AND b.query_id = st.query_id),
execs AS (
  SELECT qid AS query_id, qt AS query, wg AS workgroup, region,
    CASE WHEN event_type = 'view' AND event_id % 4 = 0 THEN NULL
      ELSE CAST(floor(value * 1e9) AS BIGINT) END AS scanned,
    CASE WHEN event_type = 'click' AND event_id % 6 = 0 THEN 'RUNNING'
      WHEN event_type = 'purchase' AND event_id % 6 = 1 THEN 'QUEUED'
      WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 10 = 1 THEN 'CANCELLED'
      ELSE 'SUCCEEDED' END AS state,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS submitted_ts,
    ts + to_minutes(event_id % 240) AS completed_ts
  FROM ev),
hist_day AS (
  SELECT query_id, query, COALESCE(scanned, 0) AS data_scanned, state AS status,
    CASE WHEN state = 'FAILED' THEN 'SYNTAX_ERROR: line 1:1'
      WHEN state = 'CANCELLED' THEN 'Query cancelled by user' ELSE '' END AS state_change_reason,
    COALESCE(strftime(submitted_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00'), '') AS submission_time,
    region, strftime(COALESCE(submitted_ts, completed_ts), '%Y-%m-%d') AS day, workgroup
  FROM execs WHERE state IN ('SUCCEEDED', 'FAILED', 'CANCELLED')),
grants AS (
  SELECT CASE WHEN user_id % 5 = 0 THEN 'arn:u' ELSE 'user' END || CAST(user_id AS VARCHAR) AS principal,
    g.catalog, g.db, g.tbl, 'SELECT' AS privileges
  FROM (SELECT DISTINCT user_id FROM events) u JOIN (VALUES
    (NULL, 'sales', 'orders', 1), (NULL, 'HR', '*', 2), ('lake', 'raw', 'clicks', 1), ('lake', 'raw', '*', 3),
    (NULL, 'raw', 'clicks', 2), (NULL, 'finance', 'ledger', 1), (NULL, 'finance', 'budget', 1), (NULL, '*', '*', 7),
    ('other', '*', '*', 5)) g(catalog, db, tbl, each) ON u.user_id % g.each = 0),
used_refs AS (
  SELECT day, lower(COALESCE(NULLIF(database, ''), 'default')) AS dbf,
    list_distinct(list_filter([source_identity, user_identity_arn, on_behalf_of_user_id], lambda x: x IS NOT NULL)) AS names,
    list_distinct(list_transform(list_transform(regexp_extract_all(query, '{REFS}', 0, 'i'),
        lambda r: regexp_extract_all(regexp_replace(r, '^\\w+\\s+', ''), '{PART}')),
      lambda p: list_transform(p, lambda x: lower(regexp_replace(x, '[`"]', '', 'g'))))) AS refs
  FROM audit),
used_tables AS (
  SELECT principal, day, COALESCE(r[-3], 'awsdatacatalog') AS catalog, COALESCE(r[-2], dbf) AS db, r[-1] AS tbl
  FROM (SELECT day, dbf, refs, unnest(names) AS principal FROM used_refs), unnest(refs) AS u(r)),
rng AS (SELECT * FROM audit WHERE day BETWEEN '{FROM_DAY}' AND '{TO_DAY}'),
search AS (
  SELECT event_time, source_identity, workgroup, status, substr(query, 1, 300) AS query_text, database,
    CAST(ROUND(data_scanned / 1048576.0, 2) AS DECIMAL(18,2)) AS data_mb,
    CAST(ROUND(cost, 6) AS DECIMAL(18,6)) AS cost_usd
  FROM rng WHERE lower(query) LIKE '%{SEARCH_TEXT}%'
  ORDER BY event_time DESC NULLS LAST, query_id ASC NULLS LAST, region ASC LIMIT 200)
"""


_GB = "CAST(ROUND(SUM(data_scanned) / 1073741824.0, 3) AS DECIMAL(18,3))"
_MB_SUM = "CAST(ROUND(SUM(data_scanned) / 1048576.0, 2) AS DECIMAL(18,2))"
_COST4 = "CAST(ROUND(SUM(cost), 4) AS DECIMAL(18,4))"
_USER = "COALESCE(source_identity, user_identity_type)"

# A grant against a use: equal principal and catalog, and the table, its
# database or everything.
_COVERS = """u.principal = g.principal AND u.catalog = lower(COALESCE(g.catalog, 'awsdatacatalog'))
        AND (g.db = '*' OR (lower(g.db) = u.db AND (g.tbl = '*' OR lower(g.tbl) = u.tbl)))"""

# The dense series of each user joined to the days of its own baseline.
_SCORES = f"""
  , sums AS (SELECT {_USER} AS user_name, CAST(day AS DATE) AS d, COUNT(*) AS queries, SUM(data_scanned) AS bytes
      FROM audit WHERE CAST(day AS DATE) BETWEEN DATE '{FROM_DAY}' - INTERVAL 14 DAY AND DATE '{TO_DAY}' GROUP BY 1, 2),
  spans AS (SELECT user_name, unnest(range(MIN(d), DATE '{TO_DAY}' + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d
      FROM sums GROUP BY 1),
  dense AS (SELECT p.user_name, p.d, COALESCE(s.queries, 0) AS queries, COALESCE(s.bytes, 0)::HUGEINT AS bytes
      FROM spans p LEFT JOIN sums s ON p.d = s.d AND p.user_name IS NOT DISTINCT FROM s.user_name),
  base AS (SELECT a.user_name, a.d, a.queries, a.bytes, COUNT(b.d) AS n, COALESCE(SUM(b.bytes), 0)::HUGEINT AS s,
        COALESCE(SUM(b.bytes * b.bytes), 0)::HUGEINT AS q
      FROM dense a LEFT JOIN dense b ON a.user_name IS NOT DISTINCT FROM b.user_name AND b.d < a.d AND b.d >= a.d - 14
      GROUP BY ALL),
  spread AS (SELECT *, sqrt((n * q - s * s)::DOUBLE) AS dev, (n * bytes - s)::DOUBLE AS above FROM base),
  scores AS (SELECT user_name, strftime(d, '%Y-%m-%d') AS day, queries, CAST(bytes AS BIGINT) AS bytes,
      CAST(n AS INTEGER) AS baseline_days,
      CASE WHEN n > 0 THEN CAST(s::DOUBLE / n AS DECIMAL(28,2)) END AS baseline_bytes,
      CASE WHEN n > 0 THEN CAST(dev / n AS DECIMAL(28,2)) END AS deviation_bytes,
      CASE WHEN n >= 7 AND dev > 0 THEN CAST(above / dev AS DECIMAL(18,3)) END AS z_score,
      CASE WHEN n >= 7 AND above > 3.0 * dev THEN CASE WHEN dev > 0 THEN 'spike' WHEN s > 0 THEN 'above_constant'
        ELSE 'after_silence' END END AS reason FROM spread)
"""

_FINAL = {
    "events_pass1": "SELECT * FROM pass1",
    "events_history_only": "SELECT * FROM hist_only",
    "events_history_only_strict": "SELECT * FROM hist_only_strict",
    "events_enriched": "SELECT * FROM staging",
    "events_enriched_strict": "SELECT * FROM pass1 UNION ALL SELECT * FROM hist_only_strict",
    "table_refs": "SELECT day, query_id, db, tbl FROM refs",
    "classified_events": "SELECT * FROM audit",
    "tier_counts": f"""
      , recs AS (SELECT query, database, COUNT(*) AS n FROM staging WHERE query IS NOT NULL GROUP BY 1, 2),
      rr AS (SELECT query, database, n, COALESCE(NULLIF(database, ''), 'default') AS dbf,
          unnest(regexp_extract_all(query, '{_PATTERN}', 1, 'i')) AS g1,
          unnest(regexp_extract_all(query, '{_PATTERN}', 2, 'i')) AS g2 FROM recs),
      rt AS (SELECT query, database, n, CASE WHEN COALESCE(g2, '') = '' THEN dbf ELSE g1 END AS db,
          CASE WHEN COALESCE(g2, '') = '' THEN g1 ELSE g2 END AS tbl FROM rr),
      per_rec AS (SELECT rt.query, rt.database, rt.n, MIN(t.tier) AS classification_tier
          FROM rt JOIN tiers t ON rt.db = t.db AND rt.tbl = t.tbl GROUP BY 1, 2, 3)
      SELECT classification_tier, CAST(SUM(n) AS BIGINT) AS classified FROM per_rec GROUP BY 1""",
    "classified_only": """SELECT * FROM audit WHERE classification_tier IS NOT NULL
      ORDER BY event_time DESC NULLS LAST, query_id ASC NULLS LAST, region ASC LIMIT 20""",
    "latest_events": """SELECT * FROM audit
      ORDER BY event_time DESC NULLS LAST, query_id ASC NULLS LAST, region ASC LIMIT 20""",
    "summary": f"""SELECT COUNT(*) AS total, COUNT(DISTINCT source_identity) AS users,
      COUNT(DISTINCT workgroup) AS workgroups,
      CAST(SUM(CASE WHEN status = 'SUCCEEDED' THEN 1 ELSE 0 END) AS BIGINT) AS ok,
      CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS fail,
      CAST(SUM(CASE WHEN status = 'CANCELLED' THEN 1 ELSE 0 END) AS BIGINT) AS cancel,
      {_GB} AS gb, {_COST4} AS total_cost FROM rng""",
    "queries_per_user_status": f"""SELECT {_USER} AS user_name, status, COUNT(*) AS cnt FROM rng
      GROUP BY 1, 2 ORDER BY cnt DESC, user_name ASC NULLS LAST, status ASC NULLS LAST LIMIT 50""",
    "status_breakdown": "SELECT COALESCE(status, 'UNKNOWN') AS status, COUNT(*) AS cnt FROM rng GROUP BY 1",
    "queries_per_day": "SELECT day, workgroup, COUNT(*) AS cnt FROM rng GROUP BY 1, 2 ORDER BY 1, 2",
    "workgroup_usage": f"""SELECT workgroup, COUNT(*) AS cnt, {_GB} AS gb, {_COST4} AS cost_usd
      FROM rng WHERE workgroup IS NOT NULL GROUP BY 1 ORDER BY cost_usd DESC, workgroup""",
    "cost_per_user": f"""SELECT {_USER} AS user_name, COUNT(*) AS queries, {_GB} AS gb, {_COST4} AS cost_usd
      FROM rng GROUP BY 1 ORDER BY cost_usd DESC NULLS LAST, user_name ASC NULLS LAST LIMIT 30""",
    "available_users": f"""SELECT source_identity, COUNT(*) AS queries FROM audit
      WHERE source_identity IS NOT NULL AND day BETWEEN '{FROM_DAY}' AND '{TO_DAY}'
      GROUP BY 1 ORDER BY 2 DESC, 1""",
    "available_workgroups": f"""SELECT workgroup, COUNT(*) AS queries FROM audit
      WHERE workgroup IS NOT NULL AND day BETWEEN '{FROM_DAY}' AND '{TO_DAY}'
      GROUP BY 1 ORDER BY 2 DESC, 1""",
    "distinct_users": "SELECT DISTINCT source_identity FROM audit WHERE source_identity IS NOT NULL ORDER BY 1",
    "distinct_workgroups": "SELECT DISTINCT workgroup FROM audit WHERE workgroup IS NOT NULL ORDER BY 1",
    "user_search": "SELECT * FROM search",
    "search_status_summary": """SELECT status, COUNT(*) AS count, CAST(SUM(data_mb) AS DECIMAL(18,2)) AS total_mb,
      CAST(SUM(cost_usd) AS DECIMAL(18,6)) AS total_cost FROM search WHERE status IS NOT NULL GROUP BY 1""",
    "top_users_by_scan": f"""SELECT source_identity AS "user",
      CAST(ROUND(SUM(data_scanned) / 1000000000.0, 2) AS DECIMAL(18,2)) AS total_data_scanned_gb
      FROM audit WHERE CAST(day AS DATE) >= DATE '{AS_OF}' - INTERVAL 7 DAY
      GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 ASC NULLS LAST LIMIT 100""",
    "cost_listing": """SELECT source_identity, data_scanned, '$' || CAST(cost AS VARCHAR) AS cost, query
      FROM audit WHERE source_identity <> ''""",
    "audit_report": """SELECT event_time AS "Timestamp", source_identity AS "User",
      on_behalf_of_user_id AS "IDC User ID", workgroup AS "Workgroup", query AS "SQL Query",
      database AS "Database", status AS "Status", data_scanned / 1048576.0 AS "Data Scanned (MB)",
      cost AS "Cost (USD)", source_ip AS "Source IP", day AS "Day" FROM audit""",
    "adhoc_rollup": f"""SELECT source_identity, workgroup, status, COUNT(*) AS cnt,
      {_MB_SUM} AS total_mb, {_COST4} AS total_cost_usd FROM audit
      WHERE day >= '{FROM_DAY}' AND source_identity IS NOT NULL
      GROUP BY 1, 2, 3 ORDER BY cnt DESC, 1, 2 NULLS LAST, 3 NULLS LAST LIMIT 50""",
    "events_count": f"SELECT COUNT(*) AS events FROM audit WHERE day BETWEEN '{FROM_DAY}' AND '{TO_DAY}'",
    "latest_partition": "SELECT MAX(day) AS latest_day FROM audit",
    "summary_no_cost": f"""SELECT COUNT(*) AS total, COUNT(DISTINCT source_identity) AS users,
      COUNT(DISTINCT workgroup) AS workgroups,
      CAST(SUM(CASE WHEN status = 'SUCCEEDED' THEN 1 ELSE 0 END) AS BIGINT) AS ok,
      CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS fail,
      CAST(SUM(CASE WHEN status = 'CANCELLED' THEN 1 ELSE 0 END) AS BIGINT) AS cancel,
      {_GB} AS gb FROM rng""",
    "workgroup_usage_by_gb": f"""SELECT workgroup, COUNT(*) AS cnt, {_GB} AS gb
      FROM rng WHERE workgroup IS NOT NULL GROUP BY 1 ORDER BY gb DESC, workgroup""",
    "user_search_no_cost": "SELECT * EXCLUDE (cost_usd) FROM search",
    "search_total_cost": "SELECT CAST(SUM(cost_usd) AS DECIMAL(28,6)) AS total_cost FROM search",
    "cross_day_duplicates": """SELECT query_id, COUNT(DISTINCT day) AS days, MIN(day) AS first_day,
      MAX(day) AS last_day, COUNT(*) AS "rows" FROM audit WHERE query_id IS NOT NULL
      GROUP BY query_id HAVING COUNT(DISTINCT day) > 1""",
    "history_day": "SELECT * FROM hist_day",
    "history_scan": "SELECT * FROM hist_day",
    "trail_scan": "SELECT * FROM staging",
    "events_sink_roundtrip": "SELECT * FROM audit",
    "backfill": "SELECT * FROM audit",
    "csv_export": "SELECT * FROM search",
    "events_heavy_split": "SELECT * FROM staging",
    "region_filtered": f"SELECT * FROM staging WHERE region = '{ONE_REGION}'",
    "user_search_filtered": f"""SELECT event_time, source_identity, workgroup, status, substr(query, 1, 300) AS query_text,
      database, CAST(ROUND(data_scanned / 1048576.0, 2) AS DECIMAL(18,2)) AS data_mb,
      CAST(ROUND(cost, 6) AS DECIMAL(18,6)) AS cost_usd FROM rng
      WHERE lower(query) LIKE '%{SEARCH_TEXT}%' AND source_identity = '{SEARCHED["user"]}'
        AND workgroup = '{SEARCHED["workgroup"]}' AND status = '{SEARCHED["status"]}'
      ORDER BY event_time DESC NULLS LAST, query_id ASC NULLS LAST, region ASC LIMIT 200""",
    "text_search": f"SELECT * FROM audit WHERE lower(query) LIKE '%{RARE_TEXT}%'",
    "adhoc_sql": ADHOC.replace("FROM events", "FROM audit"),
    "history_one_day": f"SELECT * FROM hist_day WHERE day = '{ONE_DAY}'",
    "history_run_report": """SELECT day, COUNT(DISTINCT workgroup) AS workgroups, CAST(0 AS BIGINT) AS skipped_workgroups,
      COUNT(*) AS records FROM hist_day GROUP BY day""",
    "tag_source": """SELECT p_brand AS db, 'p' || CAST(p_partkey AS VARCHAR) AS tbl,
      CASE WHEN p_partkey % 7 = 0 THEN 'tier_0' ELSE 'tier_' || CAST(p_partkey % 12 AS VARCHAR) END AS tier
      FROM part WHERE p_partkey % 7 = 0 OR p_partkey % 5 <> 0""",
    "trail_delivered": f"SELECT * FROM staging WHERE day IN {DELIVERED_DAYS}",
    "trail_quarantined": """SELECT day, r.n AS records, b.n AS bad
      FROM (SELECT day, COUNT(*) AS n FROM trail GROUP BY day) r
      FULL JOIN (SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n FROM events WHERE event_id % 50 = 0 GROUP BY 1) b USING (day)""",
    "events_catalog": "SELECT * FROM audit",
    "events_repaired": f"""SELECT * FROM audit WHERE region = '{ONE_REGION}' AND day <> '{DROPPED_DAY}'
      AND CAST(day AS DATE) BETWEEN DATE '{REPAIR_AS_OF}' - {REPAIR_BACK} AND DATE '{REPAIR_AS_OF}' - 1""",
    "catalog_report": """SELECT * FROM (SELECT 'cloud_trail' AS kind, TRUE AS planned, COUNT(*) AS rows FROM trail
      UNION ALL SELECT 'history', TRUE, COUNT(*) FROM history UNION ALL SELECT 'events_staging', TRUE, 0
      UNION ALL SELECT 'events', TRUE, COUNT(*) FROM audit UNION ALL SELECT 'absent', FALSE, NULL)""",
    "backfill_shrunk": f"SELECT * FROM audit WHERE day <> '{GONE_DAY}'",
    "latest_partition_name": "SELECT MAX(day) AS latest_day FROM audit",
    "scan_scores": f"{_SCORES} SELECT * FROM scores WHERE day >= '{FROM_DAY}'",
    "scan_anomalies": f"{_SCORES} SELECT * FROM scores WHERE day >= '{FROM_DAY}' AND reason IS NOT NULL",
    "failure_rate": """SELECT workgroup, day, COUNT(*) AS total, COUNT(*) FILTER (status = 'FAILED') AS failed,
      CAST(ROUND(COUNT(*) FILTER (status = 'FAILED') / COUNT(*), 4) AS DECIMAL(18,4)) AS failure_rate FROM rng GROUP BY 1, 2""",
    "shared_identities": """SELECT user_identity_arn, COUNT(*) AS queries, COUNT(DISTINCT user_agent) AS agents,
      COUNT(DISTINCT source_ip) AS ips FROM rng WHERE user_identity_arn IS NOT NULL
      GROUP BY 1 HAVING COUNT(DISTINCT user_agent) >= 2 OR COUNT(DISTINCT source_ip) >= 40""",
    "unused_grants": f"SELECT * FROM grants g WHERE NOT EXISTS (SELECT 1 FROM used_tables u WHERE {_COVERS})",
    "grant_usage": f"""SELECT principal, catalog, db, tbl, privileges,
      (SELECT COUNT(*) FROM used_tables u WHERE {_COVERS}) AS uses,
      (SELECT MAX(u.day) FROM used_tables u WHERE {_COVERS}) AS last_day FROM grants g""",
    "run_report": f"""SELECT '{FROM_DAY}' AS from_day, '{TO_DAY}' AS to_day, COUNT(*) AS events
      FROM audit WHERE day BETWEEN '{FROM_DAY}' AND '{TO_DAY}'""",
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, final in _FINAL.items():
        prefix = _prefix()
        if final.lstrip().startswith(","):
            out[name] = prefix.rstrip() + final
        else:
            out[name] = prefix + final
    out["null_arn_kept"] = _prefix(arn_kept=True) + "SELECT * FROM staging"
    out["workgroup_filtered"] = _prefix(WG_FILTER.strip().lower()) + "SELECT * FROM staging"
    return out | (_llm.oracle_sql() if _llm else {})
