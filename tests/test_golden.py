"""Golden cases on files: absent roots, one region only, trail and history."""

import pytest

from pyspark.sql import functions as F

from qtrail.plans.events_job import run_range
from qtrail.sources.derived import TIER_ROWS
from qtrail.sources.events import read_events
from qtrail.sources.history import read_history
from qtrail.sources.tiers import tiers_from_rows
from qtrail.sources.trail import read_trail
from tests.fixtures import (GOLDEN_HISTORY, GOLDEN_QID, GOLDEN_QID2, GOLDEN_RECORD,
                            write_history_file, write_trail_file)


def _run(spark, tmp_path, day):
    for root in ("trail", "history"):  # an absent root is an error, an absent day is not
        (tmp_path / root).mkdir(exist_ok=True)
    trail = read_trail(spark, str(tmp_path / "trail"), days=[day])
    hist = read_history(spark, str(tmp_path / "history"), days=[day])
    tiers = tiers_from_rows(spark, TIER_ROWS)
    root = str(tmp_path / "events")
    run = run_range(spark, trail, hist, tiers, root, day, day)
    return run, read_events(spark, root)


def test_trail_record_parsed_from_file(spark, tmp_path):
    write_trail_file(str(tmp_path), "us-east-1", "2024-03-02", [GOLDEN_RECORD])
    rows = read_trail(spark, str(tmp_path), days=["2024-03-02"]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.region, r.day) == ("us-east-1", "2024-03-02")
    assert r.userIdentity.principalId == "AUDITED:maria"
    assert r.userIdentity.sessionContext is None
    assert r.sourceIPAddress == "10.20.30.40"
    assert '"queryExecutionId":"%s"' % GOLDEN_QID in r.responseElements.replace(" ", "")


def test_trail_only_day_gives_one_event(spark, tmp_path):
    write_trail_file(str(tmp_path / "trail"), "us-east-1", "2024-03-02", [GOLDEN_RECORD])
    run, ev = _run(spark, tmp_path, "2024-03-02")
    assert run.events == 1
    r = ev.collect()[0]
    assert r.query.startswith("INSERT INTO mart.visits")
    assert r.data_scanned == 0 and r.cost == 0 and r.status is None
    assert r.database == "mart" and r.workgroup == "analysts"
    # day from the partition, not from the 2022 event time
    assert r.day == "2024-03-02" and str(r.event_time) == "2022-11-03 21:05:40"


def test_trail_and_history(spark, tmp_path):
    write_trail_file(str(tmp_path / "trail"), "us-east-1", "2024-03-03", [GOLDEN_RECORD])
    write_history_file(str(tmp_path / "history"), "us-east-1", "2024-03-03", "primary", GOLDEN_HISTORY)
    run, ev = _run(spark, tmp_path, "2024-03-03")
    rows = {r.query_id: r for r in ev.collect()}
    # The reference's current code adds the history-only id as well (FIXTURES §3).
    assert run.events == 2 and set(rows) == {GOLDEN_QID, GOLDEN_QID2}
    a = rows[GOLDEN_QID]
    assert (a.day, a.region, a.user_identity_principal, a.query, a.data_scanned) == \
        ("2024-03-03", "us-east-1", "AUDITED:maria", "SELECT * FROM raw.visits", 4096)
    b = rows[GOLDEN_QID2]
    assert b.event_time is None and b.user_identity_principal is None and b.workgroup == "primary"


def test_no_input_gives_zero_events(spark, tmp_path):
    (tmp_path / "trail").mkdir()
    (tmp_path / "history").mkdir()
    run, _ = _run(spark, tmp_path, "2024-03-04")
    assert run.events == 0


def test_union_all_order(spark):
    rows = spark.sql("(SELECT 1 AS col) UNION ALL (SELECT 2 AS col) ORDER BY col").collect()
    assert [r.col for r in rows] == [1, 2]


def test_history_file_read_with_partitions(spark, tmp_path):
    write_history_file(str(tmp_path), "us-east-1", "2024-03-03", "primary", GOLDEN_HISTORY)
    df = read_history(spark, str(tmp_path))
    rows = df.orderBy("query_id").collect()
    assert [(r.query_id, r.workgroup, r.day, r.region, r.data_scanned) for r in rows] == [
        (GOLDEN_QID, "primary", "2024-03-03", "us-east-1", 4096),
        (GOLDEN_QID2, "primary", "2024-03-03", "us-east-1", 512)]
    assert dict(df.dtypes)["day"] == "string"
    assert rows[0].status is None and rows[0].submission_time is None


def test_ingest_many_workgroups(spark, tmp_path):
    """10 workgroups x 100 terminal executions (+ one idle workgroup) -> 1,000 records."""
    from qtrail.plans.history_job import build_history
    from qtrail.schemas import EXECUTION
    from pyspark.sql import types as T
    rows = []
    for w in range(10):
        for i in range(100):
            rows.append((f"id-{w}-{i}", "SELECT 1", f"wg{w}", (5,),
                         ("SUCCEEDED", None, "2024-03-03T10:00:00+00:00", None), "us-east-1"))
    schema = T.StructType(EXECUTION.fields + [T.StructField("region", T.StringType())])
    ex = spark.createDataFrame(rows, schema)
    rep = build_history(ex, str(tmp_path / "h"), days=["2024-03-03"]).collect()
    assert len(rep) == 1 and rep[0].records == 1000 and rep[0].workgroups == 10
    assert read_history(spark, str(tmp_path / "h")).where(F.col("workgroup") == "wg3").count() == 100


def _executions(spark, rows):
    from qtrail.schemas import EXECUTION
    from pyspark.sql import types as T
    return spark.createDataFrame(
        [(i, "SELECT 1", wg, (5,), ("SUCCEEDED", None, at, None), "us-east-1") for i, wg, at in rows],
        T.StructType(EXECUTION.fields + [T.StructField("region", T.StringType())]))


def test_history_report_counts_listed_workgroups(spark, tmp_path):
    from qtrail.plans.history_job import build_history
    ex = _executions(spark, [(f"id-{w}-{i}", f"wg{w}", "2024-03-03T10:00:00+00:00") for w in range(10) for i in range(100)])
    listed = spark.createDataFrame([(f"wg{w}", True) for w in range(10)] + [("primary", True)], "workgroup string, readable boolean")
    rep = build_history(ex, str(tmp_path / "h"), days=["2024-03-03"], workgroups=listed).collect()
    assert [tuple(r) for r in rep] == [("2024-03-03", 11, 0, 1000)]
    empty = build_history(ex, str(tmp_path / "h"), days=["2024-03-04"]).collect()
    assert [tuple(r) for r in empty] == [("2024-03-04", 0, 0, 0)]


def test_history_force_and_exact_workgroup(spark, tmp_path):
    from qtrail.plans.history_job import build_history
    root, day = str(tmp_path / "h"), ["2024-03-03"]
    at = "2024-03-03T10:00:00+00:00"
    both = _executions(spark, [("1", "a", at), ("2", "ab", at)])
    build_history(both, root, days=day, workgroup="a")
    assert [r.workgroup for r in read_history(spark, root).collect()] == ["a"]
    build_history(both, root, days=day)
    build_history(_executions(spark, [("1", "a", at)]), root, days=day)
    assert read_history(spark, root).count() == 2          # without force, absent groups stay
    build_history(_executions(spark, [("1", "a", at)]), root, days=day, force=True)
    assert [r.workgroup for r in read_history(spark, root).collect()] == ["a"]


def test_epoch_times_are_dated_and_undated_counted(spark):
    from qtrail.operators.ingest import history_rows, undated_executions
    ex = _executions(spark, [("1", "a", "1709460000.123"), ("2", "a", "2024-03-03T10:00:00Z"), ("3", "a", "soon")])
    rows = {r.query_id: (r.day, r.submission_time) for r in history_rows(ex).collect()}
    assert rows == {"1": ("2024-03-03", "2024-03-03T10:00:00.123000+00:00"), "2": ("2024-03-03", "2024-03-03T10:00:00Z")}
    assert undated_executions(ex).first()["undated"] == 1


def test_absent_root_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_trail(spark, str(tmp_path / "typo"), days=["2024-03-02"])
    with pytest.raises(FileNotFoundError):
        read_history(spark, str(tmp_path / "typo"), days=["2024-03-02"])


def test_inputs_of_one_region_leave_the_other_alone(spark, tmp_path):
    for region in ("us-east-1", "eu-west-1"):
        write_trail_file(str(tmp_path / "trail"), region, "2024-03-02", [GOLDEN_RECORD])
    _, both = _run(spark, tmp_path, "2024-03-02")
    assert both.count() == 2
    trail = read_trail(spark, str(tmp_path / "trail"), days=["2024-03-02"], regions=["us-east-1"])
    hist = read_history(spark, str(tmp_path / "history"), days=["2024-03-02"])
    run_range(spark, trail, hist, tiers_from_rows(spark, TIER_ROWS), str(tmp_path / "events"), "2024-03-02", "2024-03-02")
    left = read_events(spark, str(tmp_path / "events"))
    assert {r.region for r in left.collect()} == {"us-east-1", "eu-west-1"}
