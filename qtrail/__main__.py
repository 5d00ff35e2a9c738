"""Command line: ``python -m qtrail {events,history,report} ...``.

tables   create (or force re-create) the catalog tables and register partitions (S9-S13), or report on them
events   rebuild a day / day range of the events table (X4, X5)
history  build history partitions from landed execution records (X3)
report   run one report over the events table and print or export it
"""

from __future__ import annotations

import argparse
import json
from decimal import Decimal

from qtrail.config import DEFAULT_COST_PER_TB, AuditConfig


def _cfg(a) -> AuditConfig:
    return AuditConfig(audit_db=a.audit_db, cost_per_tb=Decimal(a.cost_per_tb),
                       workgroups_filter=a.workgroups_filter or "",
                       regions=tuple(r for r in (a.regions or "").split(",") if r),
                       strict_not_in=a.strict_not_in, keep_null_arn=a.keep_null_arn)


def _whole_range(a) -> None:
    if bool(a.from_day) != bool(a.to_day):
        raise SystemExit("--from and --to go together")


def _pairs(items) -> dict[str, str]:
    out = dict(i.split("=", 1) for i in items or [] if "=" in i)
    if len(out) != len(items or []):
        raise SystemExit("give kind=value, each kind once")
    return out


def _tables(a):
    """The catalog tables of ``--db`` (None without it); roots named by other
    options are those tables' folders."""
    from qtrail.plans.tables import TableSet
    if not a.db:
        return None
    roots = {"events": a.events_root, "history": a.history_root, "cloud_trail": a.trail_root}
    return TableSet(a.db, a.root or "", _pairs(a.table), {k: v for k, v in roots.items() if v} | _pairs(a.folder))


def cmd_events(spark, a) -> dict:
    from qtrail.plans.events_job import range_for, run_range
    from qtrail.sources.history import read_history
    from qtrail.sources.tiers import tiers_from_rows, tiers_from_table, tiers_from_tag_dump
    from qtrail.functions import predicates as P
    from qtrail.operators.monitoring import write_identity_sketches
    from qtrail.operators.textsearch import write_index
    from qtrail.plans.publish import new_run
    from qtrail.sources.events import read_events
    from qtrail.sources.trail import read_trail, set_aside
    from qtrail.functions.calendar import days_between
    from qtrail.plans.tables import add_trail_partitions, init_tables
    cfg = _cfg(a)
    _whole_range(a)
    if a.from_day and a.to_day:
        lo, hi = a.from_day, a.to_day
    else:
        lo, hi = range_for(a.force_recreate, a.day)
    days = days_between(lo, hi)
    regions = list(cfg.regions) or None
    tables = _tables(a)
    if tables:
        init_tables(spark, tables, cfg.regions, force=a.force_recreate)
        if a.trail_layout == "native":
            add_trail_partitions(spark, tables, days, cfg.regions)
    aside = {}
    if a.quarantine:
        target = f"{a.quarantine.rstrip('/')}/{new_run()}"
        aside["unreadable"] = set_aside(spark, a.trail_root, target, days, regions, a.trail_layout, a.max_bad)
    trail = read_trail(spark, a.trail_root, days, regions, layout=a.trail_layout)
    hist = read_history(spark, a.history_root, days, regions)
    if a.tiers:
        tiers = tiers_from_tag_dump(spark, a.tiers)
    elif a.tiers_table:
        tiers = tiers_from_table(spark, a.tiers_table)
    else:  # no tier map: every event keeps a NULL tier
        tiers = tiers_from_rows(spark, [])
    run = run_range(spark, trail, hist, tiers, a.events_root, lo, hi, cfg, tables and tables.name("events"))
    if a.text_index and not tables:
        write_index(spark, a.events_root, days)
    if a.sketches:
        built = spark.table(tables.name("events")) if tables else read_events(spark, a.events_root, days)
        write_identity_sketches(built.where(P.in_days(days)), a.sketches)
    return {"from_day": run.from_day, "to_day": run.to_day, "events": run.events, "classified": run.classified} | aside


def cmd_history(spark, a) -> dict:
    from qtrail.functions.calendar import days_between, yesterday
    from qtrail.operators.ingest import undated_executions
    from qtrail.plans.history_job import build_history
    from qtrail.sources.executions import read_executions
    _whole_range(a)
    days = days_between(a.from_day, a.to_day) if a.from_day and a.to_day else [a.day or yesterday()]
    ex = read_executions(spark, a.executions, region=a.region)
    rep = build_history(ex, a.history_root, days, a.workgroups_filter or "", a.workgroup, a.force)
    return {"days": [r.asDict() for r in rep.orderBy("day").collect()],
            "undated": undated_executions(ex).first()["undated"]}


def cmd_tables(spark, a) -> dict:
    from qtrail.plans.tables import KINDS, init_tables, latest_partition, tables_report
    tables = _tables(a)
    regions = [r for r in (a.regions or "").split(",") if r]
    created = init_tables(spark, tables, regions, a.days_back, a.force)
    report = tables_report(spark, [tables.name(k) for k in KINDS])
    return {"created": created, "latest_day": latest_partition(spark, tables.folder("events")),
            "tables": [r.asDict() for r in report.collect()]}


REPORTS = ("summary", "queries_per_user_status", "status_breakdown", "queries_per_day", "workgroup_usage",
           "cost_per_user", "available_users", "available_workgroups", "distinct_users",
           "distinct_workgroups", "user_search", "search_status_summary", "top_users_by_scan",
           "cost_listing", "audit_report", "adhoc_rollup", "latest_events", "classified_only",
           "events_count", "latest_day", "failure_rate", "scan_scores", "scan_anomalies", "shared_identities",
           "unused_grants", "grant_usage", "sql")


def cmd_report(spark, a):
    from qtrail.functions import predicates as P
    from qtrail.operators import grants as G
    from qtrail.operators import monitoring as M
    from qtrail.operators import reports as R
    from qtrail.operators.textsearch import events_containing
    from qtrail.sources.events import read_events
    from qtrail.sources.grants import grants_from_permission_dump, grants_from_table
    from qtrail.config import BASELINE_DAYS
    from qtrail.functions.calendar import day_back, day_range_start, days_between
    days = days_between(a.from_day, a.to_day) if a.from_day and a.to_day else None
    lo, hi = a.from_day or "0000-01-01", a.to_day or "9999-12-31"
    # A bounded range lists only its day folders; the range holds for every report.
    # A text is looked for only in files that can hold it.
    ev = events_containing(spark, a.events_root, a.contains, days) if a.contains else read_events(spark, a.events_root, days)
    if a.from_day or a.to_day:
        ev = ev.where(P.search_filter(lo, hi))
    pred = P.search_filter(lo, hi, a.user, a.workgroup, a.status, a.contains)
    n = a.name
    if n in ("unused_grants", "grant_usage"):
        if not (a.grants or a.grants_table):
            raise SystemExit(f"{n} needs --grants or --grants-table")
        grants = grants_from_permission_dump(spark, a.grants) if a.grants else grants_from_table(spark, a.grants_table)
        return getattr(G, n)(grants, ev, AuditConfig(audit_db=a.audit_db))
    if n in ("scan_scores", "scan_anomalies"):
        if not days:
            raise SystemExit(f"{n} needs --from and --to")
        # The baseline reaches back before the range.
        back = read_events(spark, a.events_root, days_between(day_range_start(lo, BASELINE_DAYS), hi))
        return getattr(M, n)(back, lo, hi)
    if n == "shared_identities":
        sketches = (M.read_identity_sketches(spark, a.sketches, lo, hi) if a.sketches else M.identity_sketches(ev))
        return M.shared_identities(ev, sketches, lo, hi)
    if n == "sql":
        return R.adhoc_sql(ev, a.sql)
    if n in ("user_search", "search_status_summary"):
        s = R.user_search(ev, pred, a.limit)
        return s if n == "user_search" else R.search_status_summary(s)
    if n in ("available_users", "available_workgroups", "events_count"):
        return getattr(R, n)(ev, lo, hi)
    if n in ("distinct_users", "distinct_workgroups", "cost_listing", "audit_report", "latest_day"):
        return getattr(R, n)(ev)
    if n == "top_users_by_scan":
        return R.top_users_by_scan(ev, a.as_of or day_back(0))
    if n == "adhoc_rollup":
        return R.adhoc_rollup(ev, lo)
    if n in ("latest_events", "classified_only"):
        return R.latest_events(ev, classified_only=n == "classified_only")
    return getattr(M if n == "failure_rate" else R, n)(ev, pred)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="qtrail")
    sub = ap.add_subparsers(dest="cmd", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--master", default=None)
    common.add_argument("--day")
    common.add_argument("--from", dest="from_day")
    common.add_argument("--to", dest="to_day")
    common.add_argument("--workgroups-filter", default="")
    common.add_argument("--input-bytes", type=int, help="expected input size; sizes shuffle partitions")
    common.add_argument("--total-cores", type=int, default=0, help="cluster cores (default: session parallelism)")
    catalog = argparse.ArgumentParser(add_help=False)
    catalog.add_argument("--root", help="base folder of the tables")
    catalog.add_argument("--table", action="append", metavar="KIND=NAME", help="name of a table, default its kind")
    catalog.add_argument("--folder", action="append", metavar="KIND=PATH", help="folder of a table, default its kind")
    catalog.add_argument("--regions", help="comma-separated; default: all there are")
    e = sub.add_parser("events", parents=[common, catalog])
    e.add_argument("--db", help="publish through the catalog tables of this database")
    e.add_argument("--trail-root", required=True)
    e.add_argument("--trail-layout", choices=("native", "hive"), default="native")
    e.add_argument("--quarantine", help="write unreadable parts of trail files under this folder, and count them")
    e.add_argument("--max-bad", type=int, help="fail before the build if there are more of them")
    e.add_argument("--history-root", required=True)
    e.add_argument("--events-root", required=True)
    e.add_argument("--tiers", help="tag-search JSON dump")
    e.add_argument("--tiers-table", help="(db, tbl, tier) table: .parquet folder, .csv or .json")
    e.add_argument("--audit-db", default="default")
    e.add_argument("--cost-per-tb", default=DEFAULT_COST_PER_TB)
    e.add_argument("--text-index", action="store_true", help="index the texts of the days for searches")
    e.add_argument("--sketches", help="store the identity sketches of the days in this folder")
    e.add_argument("--force-recreate", action="store_true")
    e.add_argument("--strict-not-in", action="store_true")
    e.add_argument("--keep-null-arn", action="store_true")
    t = sub.add_parser("tables", parents=[common, catalog])
    t.add_argument("--db", default="default")
    for kind in ("events", "history", "trail"):
        t.add_argument(f"--{kind}-root")
    t.add_argument("--days-back", type=int, default=14)
    t.add_argument("--force", action="store_true")
    h = sub.add_parser("history", parents=[common])
    h.add_argument("--executions", required=True)
    h.add_argument("--history-root", required=True)
    h.add_argument("--region")
    h.add_argument("--workgroup", help="this workgroup alone, by its exact name")
    h.add_argument("--force", action="store_true", help="clear the days first")
    r = sub.add_parser("report", parents=[common])
    r.add_argument("name", choices=REPORTS)
    r.add_argument("--events-root", required=True)
    r.add_argument("--user")
    r.add_argument("--workgroup")
    r.add_argument("--status")
    r.add_argument("--contains")
    r.add_argument("--limit", type=int, default=200)
    r.add_argument("--as-of")
    r.add_argument("--sql")
    r.add_argument("--grants", help="permission listing (JSON)")
    r.add_argument("--grants-table", help="(principal, catalog, db, tbl, privileges): .parquet folder, .csv or .json")
    r.add_argument("--audit-db", default="default")
    r.add_argument("--sketches", help="folder of stored identity sketches (default: made from the events)")
    r.add_argument("--csv", help="export the result as CSV to this folder")
    r.add_argument("--show", type=int, default=2**31 - 2)
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession
    from qtrail.session import build_session, clean_scratch
    own = SparkSession.getActiveSession() is None
    spark = build_session(master=a.master)
    try:
        run(spark, a)
    finally:
        if own:  # not in a session that others go on with
            clean_scratch(spark)


def run(spark, a) -> None:
    from qtrail.operators.reports import export_csv
    from qtrail.session import apply_conf, cluster_conf
    if a.input_bytes:
        cores = a.total_cores or spark.sparkContext.defaultParallelism
        apply_conf(spark, cluster_conf(a.input_bytes, cores))
    if a.cmd == "events":
        print(json.dumps(cmd_events(spark, a)))
    elif a.cmd == "tables":
        print(json.dumps(cmd_tables(spark, a)))
    elif a.cmd == "history":
        print(json.dumps(cmd_history(spark, a)))
    else:
        df = cmd_report(spark, a)
        if a.csv:
            export_csv(df, a.csv)
        else:
            df.show(a.show, truncate=False)


if __name__ == "__main__":
    main()
