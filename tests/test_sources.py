"""Tier-tag dump (S16), catalog maintenance (S9-S13), execution ingest
(S3 P9 P10 F6 F7) and trail folder selection (S1, F3)."""

import json

import pytest
from pyspark.sql import types as T

from qtrail.operators.ingest import history_rows
from qtrail.schemas import EXECUTION
from qtrail.sources.tiers import tiers_from_tag_dump
from qtrail.sources.trail import read_trail, trail_glob
from tests.fixtures import GOLDEN_RECORD, write_trail_file


def _tbl(db, name, tags):
    return {"Table": {"DatabaseName": db, "Name": name},
            "LFTagsOnTable": [{"TagKey": k, "TagValues": v} for k, v in tags]}


def test_tag_dump(spark, tmp_path):
    page1 = {"TableList": [
        _tbl("sales", "orders", [("owner", ["x"]), ("classification_tier", ["tier_2", "tier_9"])]),
        _tbl("hr", "people", [("classification_tier", [])]),                 # no value: skipped
        _tbl("hr", "salaries", [("classification_tier", ["tier_3"])]),
    ]}
    page2 = {"TableList": [_tbl("hr", "salaries", [("classification_tier", ["tier_1"])])]}  # later wins
    (tmp_path / "dump.json").write_text(json.dumps(page1) + "\n" + json.dumps(page2) + "\n")
    got = sorted(map(tuple, tiers_from_tag_dump(spark, str(tmp_path / "dump.json")).collect()))
    assert got == [("hr", "salaries", "tier_1"), ("sales", "orders", "tier_2")]


def test_execution_ingest(spark):
    schema = T.StructType(EXECUTION.fields + [T.StructField("region", T.StringType())])
    rows = [
        ("a", "SELECT 1", "wg", (10,), ("SUCCEEDED", None, "2024-03-03T23:59:00+00:00", None), "r"),
        ("b", "SELECT 2", "wg", (None,), ("FAILED", "boom", None, "2024-03-04T00:01:00+00:00"), "r"),
        ("c", "SELECT 3", "wg", (5,), ("RUNNING", None, "2024-03-03T10:00:00+00:00", None), "r"),
        ("d", "SELECT 4", "WG-Other", None, ("CANCELLED", None, None, None), "r"),   # no day at all
        ("e", "SELECT 5", "Team_X", (1,), ("SUCCEEDED", None, "2024-03-03T01:00:00+02:00", None), "r"),
    ]
    ex = spark.createDataFrame(rows, schema)
    got = {r.query_id: r for r in history_rows(ex).collect()}
    assert set(got) == {"a", "b", "e"}
    assert (got["a"].day, got["a"].data_scanned, got["a"].state_change_reason) == ("2024-03-03", 10, "")
    assert (got["b"].day, got["b"].data_scanned, got["b"].submission_time) == ("2024-03-04", 0, "")
    assert got["e"].day == "2024-03-03"  # wall-clock day of the written time
    assert {r.query_id for r in history_rows(ex, days=["2024-03-04"]).collect()} == {"b"}
    assert {r.query_id for r in history_rows(ex, workgroups_filter=" team ").collect()} == {"e"}


def test_trail_glob_selects_only_requested_days(spark, tmp_path):
    root = str(tmp_path)
    for day in ("2024-01-30", "2024-01-31", "2024-02-01"):
        write_trail_file(root, "us-east-1", day, [GOLDEN_RECORD])
    write_trail_file(root, "eu-west-1", "2024-01-31", [GOLDEN_RECORD])
    assert trail_glob(root, ["2024-01-31", "2024-02-01"], ["us-east-1"]) == \
        f"{root}/us-east-1/{{2024/01/31,2024/02/01}}"
    df = read_trail(spark, root, days=["2024-01-31", "2024-02-01"], regions=["us-east-1"])
    assert sorted((r.region, r.day) for r in df.collect()) == [("us-east-1", "2024-01-31"),
                                                              ("us-east-1", "2024-02-01")]
    assert read_trail(spark, root, days=["2023-05-05"]).count() == 0
    assert read_trail(spark, root).count() == 4


def test_day_globs_for_hive_tables(spark, tmp_path):
    from qtrail.sources.events import read_events
    from qtrail.sources.history import read_history
    from tests.fixtures import GOLDEN_HISTORY, write_history_file
    for d in ("2024-03-03", "2024-03-04"):
        write_history_file(str(tmp_path / "h"), "us-east-1", d, "primary", GOLDEN_HISTORY)
    write_history_file(str(tmp_path / "h"), "eu-west-1", "2024-03-04", "wg2", GOLDEN_HISTORY)
    h = read_history(spark, str(tmp_path / "h"), days=["2024-03-04"], regions=["eu-west-1"])
    assert {(r.region, r.day, r.workgroup) for r in h.collect()} == {("eu-west-1", "2024-03-04", "wg2")}
    assert read_history(spark, str(tmp_path / "h"), days=["2030-01-01"]).count() == 0
    assert read_history(spark, str(tmp_path / "h")).count() == 6
    (tmp_path / "nothing").mkdir()
    assert read_events(spark, str(tmp_path / "nothing"), days=["2024-03-04"]).count() == 0
    with pytest.raises(FileNotFoundError):  # a mistyped root is not an empty table
        read_events(spark, str(tmp_path / "typo"), days=["2024-03-04"])


def test_tiers_from_table(spark, tmp_path):
    from qtrail.sources.tiers import tiers_from_table
    (tmp_path / "t.csv").write_text("db,tbl,tier\nsales,orders,tier_2\nhr,people,tier_1\n")
    got = sorted(map(tuple, tiers_from_table(spark, str(tmp_path / "t.csv")).collect()))
    assert got == [("hr", "people", "tier_1"), ("sales", "orders", "tier_2")]
