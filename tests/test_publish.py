"""Catalog tables (S9-S13, S17, U2) and the publishing of builds (S6-S8):
what readers see after a build, after one that failed, and after a re-run."""

import os

import pytest
from pyspark.sql import functions as F

from qtrail.functions.calendar import day_back
from qtrail.operators import classify as CL
from qtrail.operators import enrich as EN
from qtrail.plans import events_job
from qtrail.plans import publish as PUB
from qtrail.plans import tables as TB
from qtrail.schemas import EVENT_COLUMNS, EVENT_PARTITIONS, EXECUTION
from qtrail.sources.events import read_events, write_events
from qtrail.sources.history import read_history
from qtrail.sources.tiers import tiers_from_rows
from tests.fixtures import GOLDEN_HISTORY, GOLDEN_RECORD, history_df, trail_df, trail_row, write_history_file, \
    write_trail_file

D1, D2, D3 = "2024-01-02", "2024-01-03", "2024-01-04"


@pytest.fixture
def tables(spark, tmp_path):
    t = TB.TableSet("qtrail_pub", str(tmp_path), {"events": "audit_events"}, {"cloud_trail": str(tmp_path / "elsewhere")})
    spark.sql("DROP DATABASE IF EXISTS qtrail_pub CASCADE")
    TB.init_tables(spark, t)
    yield t
    spark.sql("DROP DATABASE IF EXISTS qtrail_pub CASCADE")


def build(spark, tables, rows, lo=D1, hi=D2, table=True, **more):
    root = tables.folder("events")
    return events_job.run_range(spark, trail_df(spark, rows), history_df(spark, []), tiers_from_rows(spark, []), root, lo, hi,
                                table=tables.name("events") if table else None, **more)


def seen(spark, tables):
    return sorted((r.region, r.day, r.query_id) for r in spark.table(tables.name("events")).collect())


def by_path(spark, root):
    return sorted((r.region, r.day, r.query_id) for r in read_events(spark, root).collect())


def test_all_tables_are_made_once_and_planned(spark, tables):
    names = [tables.name(k) for k in TB.KINDS]
    assert names[3] == "`qtrail_pub`.`audit_events`" and tables.folder("cloud_trail").endswith("/elsewhere")
    assert TB.tables_exist(spark, names) and TB.tables_exist(spark, [])
    assert not TB.tables_exist(spark, [*names, "qtrail_pub.absent"])
    assert TB.init_tables(spark, tables) is False
    spark.sql(f"DROP TABLE {tables.name('history')}")
    assert not TB.tables_exist(spark, names)
    assert TB.init_tables(spark, tables) is True
    with pytest.raises(ValueError):
        TB.TableSet(names={"evnts": "x"})


def test_report_names_missing_tables_and_folders(spark, tables):
    build(spark, tables, [trail_row("a")])
    os.makedirs(tables.folder("history"))
    rows = {r.table: r for r in TB.tables_report(spark, [*(tables.name(k) for k in TB.KINDS), "qtrail_pub.absent"]).collect()}
    assert rows[tables.name("events")].planned and rows[tables.name("events")].folder_exists
    assert rows[tables.name("history")].folder_exists
    assert rows[tables.name("events_staging")].planned and rows[tables.name("events_staging")].folder_exists is False
    assert rows[tables.name("cloud_trail")].planned
    assert not rows["qtrail_pub.absent"].planned and rows["qtrail_pub.absent"].location is None


def test_table_shows_exactly_what_was_built(spark, tables):
    run = build(spark, tables, [trail_row("a"), trail_row("b", day=D2), trail_row("c", region="eu-west-1", day=D2)])
    assert run.events == 3
    assert seen(spark, tables) == [("eu-west-1", D2, "c"), ("us-east-1", D1, "a"), ("us-east-1", D2, "b")]
    # A re-run without (us-east-1, D1) and with another row in D2; another day stays.
    build(spark, tables, [trail_row("z", day=D3)], D3, D3)
    build(spark, tables, [trail_row("b2", day=D2)])
    assert seen(spark, tables) == [("eu-west-1", D2, "c"), ("us-east-1", D2, "b2"), ("us-east-1", D3, "z")]
    # Old folders are gone; every version left is one that the table points at.
    assert TB.event_places(spark, tables.folder("events")).keys() == PUB.registered(spark, tables.name("events"), EVENT_PARTITIONS)
    assert TB.latest_registered(spark, tables.name("events")).collect()[0].latest_day == D3


def failing(spark):
    """Rows that cannot be written: the task fails after it began."""
    return trail_df(spark, [trail_row("x"), trail_row("y", day=D2)]).withColumn(
        "eventTime", F.when(F.col("day") == D2, F.raise_error(F.lit("lost"))).otherwise(F.col("eventTime")))


@pytest.mark.parametrize("table", [True, False])
def test_a_failed_build_leaves_the_old_rows(spark, tables, table, monkeypatch):
    rows = [trail_row("a"), trail_row("b", day=D2)]
    build(spark, tables, rows, table=table)
    look = (lambda: seen(spark, tables)) if table else (lambda: by_path(spark, tables.folder("events")))
    old = look()
    assert [q for _, _, q in old] == ["a", "b"]
    with pytest.raises(Exception, match="lost"):
        events_job.run_range(spark, failing(spark), history_df(spark, []), tiers_from_rows(spark, []), tables.folder("events"),
                             D1, D2, table=tables.name("events") if table else None)
    assert look() == old
    # Written, and then the driver dies before it publishes.
    name = "publish_to_table" if table else "publish_to_folders"
    with monkeypatch.context() as m:
        m.setattr(PUB, name, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver gone")))
        with pytest.raises(RuntimeError):
            build(spark, tables, [trail_row("new")], table=table)
    assert look() == old
    # What is left behind can be taken away, and the job run again.
    if table:
        assert PUB.remove_unreferenced(spark, tables.name("events"), tables.folder("events"), EVENT_PARTITIONS) >= 1
    else:
        assert PUB.remove_unpublished(spark, tables.folder("events")) >= 1
    assert look() == old
    build(spark, tables, [trail_row("new")], table=table)
    assert [q for _, _, q in look()] == ["new"]


def test_a_failure_within_publishing_keeps_partitions_whole(spark, tables, monkeypatch):
    build(spark, tables, [trail_row("a"), trail_row("b", day=D2)], table=False)
    moved = []
    known = PUB.FS.move

    def move(s, source, target):
        moved.append(target)
        if len(moved) == 4:  # D1 is replaced, D2's old rows are aside
            raise OSError("no")
        known(s, source, target)

    with monkeypatch.context() as m:
        m.setattr(PUB.FS, "move", move)
        with pytest.raises(OSError):
            build(spark, tables, [trail_row("a2"), trail_row("b2", day=D2)], table=False)
    assert [q for _, _, q in by_path(spark, tables.folder("events"))] == ["a2"]
    build(spark, tables, [trail_row("a2"), trail_row("b2", day=D2)], table=False)
    assert [q for _, _, q in by_path(spark, tables.folder("events"))] == ["a2", "b2"]


def test_keep_old_leaves_folders_for_running_readers(spark, tables):
    build(spark, tables, [trail_row("a")])
    frame = spark.table(tables.name("events"))  # its files are listed when it runs
    old = PUB.location(spark, tables.name("events"), EVENT_PARTITIONS, ("us-east-1", D1))
    build(spark, tables, [trail_row("b")], keep_old=True)
    assert os.path.isdir(old.removeprefix("file:")) and frame.count() == 1
    assert PUB.remove_unreferenced(spark, tables.name("events"), tables.folder("events"), EVENT_PARTITIONS) == 1
    assert [q for _, _, q in seen(spark, tables)] == ["b"]


def test_made_anew_tables_find_versions_and_plain_folders(spark, tables):
    days = [day_back(2), day_back(1)]
    events = CL.classify(EN.staging(trail_df(spark, [trail_row("old", day="2020-01-01"), trail_row("p", day=days[0])]),
                                    history_df(spark, [])), tiers_from_rows(spark, []))
    write_events(events, tables.folder("events"))
    build(spark, tables, [trail_row("v", day=days[1])], days[1], days[1])
    assert [q for _, _, q in seen(spark, tables)] == ["v"]
    assert TB.init_tables(spark, tables, ["us-east-1"], force=True)  # last 14 days of the region
    assert [q for _, _, q in seen(spark, tables)] == ["p", "v"]
    assert TB.repair_events(spark, tables) == 3
    assert [q for _, _, q in seen(spark, tables)] == ["old", "p", "v"]
    assert TB.repair_events(spark, tables, 1, ["us-east-1"]) == 1
    TB.drop_partitions(spark, tables.name("events"), [("us-east-1", "2020-01-01")])
    assert [q for _, _, q in seen(spark, tables)] == ["p", "v"]
    assert TB.delete_partition_dirs(spark, tables.folder("events"), [("us-east-1", "2020-01-01"), ("us-east-1", "2020-01-0")]) == 1


def test_an_unfinished_version_is_not_registered(spark, tables):
    build(spark, tables, [trail_row("a")])
    root = tables.folder("events")
    version = PUB.write_version(spark.table(tables.name("events")).withColumn("query_id", F.lit("half")).select(*EVENT_COLUMNS),
                                root, EVENT_PARTITIONS)
    os.remove(f"{version}/_SUCCESS")
    TB.repair_events(spark, tables)
    assert [q for _, _, q in seen(spark, tables)] == ["a"]


def test_history_and_trail_partitions(spark, tables):
    write_history_file(tables.folder("history"), "us-east-1", D1, "a b", GOLDEN_HISTORY)
    TB.repair_history(spark, tables)
    got = spark.table(tables.name("history")).collect()
    assert {(r.region, r.day, r.workgroup) for r in got} == {("us-east-1", D1, "a b")} and len(got) == 2
    for d in (D1, D2):
        write_trail_file(tables.folder("cloud_trail"), "us-east-1", d, [GOLDEN_RECORD, GOLDEN_RECORD])
    assert TB.add_trail_partitions(spark, tables, [D1, D3], ["us-east-1", "eu-west-1"]) == 1
    trail = spark.table(tables.name("cloud_trail"))
    assert trail.columns[-4:] == list(TB.TRAIL_PARTITIONS)
    assert [(r.eventName, r.region, r.month, r.day) for r in trail.collect()] == [("StartQueryExecution", "us-east-1", "01", "02")] * 2
    assert TB.add_trail_partitions(spark, tables, [D1, D2], ["us-east-1"]) == 2
    assert spark.table(tables.name("cloud_trail")).count() == 4


def test_latest_partition_from_names(spark, tmp_path):
    root = tmp_path / "events"
    assert TB.latest_partition(spark, str(root)) is None
    for d in ("region=a/day=2024-01-09", "region=b/day=2024-01-30", "region=c/day=hello", "_version/x/region=a/day=2031-01-01"):
        os.makedirs(root / d)
        (root / d / "part-0.parquet").write_bytes(b"not parquet: never opened")
    assert TB.latest_partition(spark, str(root)) == "2024-01-30"
    os.makedirs(root / "day=2023-01-01")  # the top level goes first
    assert TB.latest_partition(spark, str(root)) == "2023-01-01"


def test_forced_history_writes_before_it_clears(spark, tmp_path, monkeypatch):
    from pyspark.sql import types as T
    from qtrail.plans import history_job
    schema = T.StructType(EXECUTION.fields + [T.StructField("region", T.StringType())])

    def executions(*rows):
        return spark.createDataFrame([(q, "SELECT 1", wg, (1,), ("SUCCEEDED", None, f"{D1}T10:00:00Z", None), "r")
                                      for q, wg in rows], schema)

    root = str(tmp_path / "h")
    history_job.build_history(executions(("1", "a"), ("2", "ab"), ("3", "c")), root, [D1])
    bad = executions(("4", "a")).withColumn("Query", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        history_job.build_history(bad, root, [D1], force=True)
    assert read_history(spark, root).count() == 3
    history_job.build_history(executions(("5", "a")), root, [D1], workgroup="a", force=True)  # 'ab' is another workgroup
    assert sorted(r.query_id for r in read_history(spark, root).collect()) == ["2", "3", "5"]
    history_job.build_history(executions(("6", "c")), root, [D1], force=True)
    assert [r.query_id for r in read_history(spark, root).collect()] == ["6"]
    with pytest.raises(ValueError):
        history_job.build_history(executions(("6", "c")), root, force=True)


def test_cli_builds_into_the_catalog(spark, tmp_path, capsys):
    import json
    from qtrail.__main__ import main
    write_trail_file(str(tmp_path / "t"), "us-east-1", D1, [GOLDEN_RECORD])
    write_history_file(str(tmp_path / "h"), "us-east-1", D1, "primary", GOLDEN_HISTORY)
    roots = ["--trail-root", str(tmp_path / "t"), "--history-root", str(tmp_path / "h"), "--events-root", str(tmp_path / "e"),
             "--root", str(tmp_path), "--db", "qtrail_cli", "--table", "events=audit", "--regions", "us-east-1"]
    try:
        for _ in range(2):
            main(["events", *roots, "--day", D1])
            assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["events"] == 2
        assert spark.table("qtrail_cli.audit").count() == 2 and spark.table("qtrail_cli.cloud_trail").count() == 1
        main(["tables", *roots, "--force"])
        out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
        assert out["created"] and [t["planned"] for t in out["tables"]] == [True] * 4
    finally:
        spark.sql("DROP DATABASE IF EXISTS qtrail_cli CASCADE")


def test_scratch_is_the_applications_own_and_goes(spark):
    from qtrail.session import clean_scratch, scratch_path, scratch_root
    other = spark.newSession()
    path = scratch_path(other, "x")
    assert path.startswith(scratch_root(spark)) and spark.sparkContext.applicationId in path
    spark.range(3).write.parquet(path)
    assert PUB.FS.exists(spark, path)
    assert clean_scratch(spark) and not PUB.FS.exists(spark, path) and not clean_scratch(spark)
