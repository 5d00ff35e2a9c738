"""F8 text search through the trigram index: the rows of a plain scan, from
few files when the text is rare."""

import os

import pytest

from qtrail.functions import predicates as P
from qtrail.operators import textsearch as TS
from qtrail.schemas import EVENTS
from qtrail.sources.events import read_events, write_events
from tests.test_monitoring import COLS, event

DAYS = [f"2024-01-{n:02d}" for n in range(1, 31)]
TEXTS = ["SELECT * FROM Sales.Orders", "insert into t\nselect 'Grüße' from x", "", None, "ab", "SELECT 1 -- " + "x" * 50_000]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    rows = []
    for n, day in enumerate(DAYS):
        for k, text in enumerate([*TEXTS, f"SELECT * FROM days WHERE n = 'marker-{n}'"]):
            row = list(event(day, n=100 * n + k))
            row[COLS.index("query")] = text
            rows.append(tuple(row))
    where = str(tmp_path_factory.mktemp("search") / "events")
    write_events(spark.createDataFrame(rows, EVENTS), where)
    TS.write_index(spark, where)
    return where


def plain(spark, root, text, days=None):
    rows = read_events(spark, root, days).where(P.all_of(P.in_days(days), P.contains_text(text)))
    return sorted(r.query_id for r in rows.collect())


@pytest.mark.parametrize("text", ["marker-7'", "MARKER-2", "orders", "grüße' from", "t\nselect", "x" * 300, "no such text", "ab", "q", "  ",
                                  "marker-31"])
def test_same_rows_as_a_scan(spark, root, text):
    assert sorted(r.query_id for r in TS.events_containing(spark, root, text).collect()) == plain(spark, root, text)
    some = DAYS[5:9]
    assert sorted(r.query_id for r in TS.events_containing(spark, root, text, some).collect()) == plain(spark, root, text, some)


def test_a_rare_text_opens_few_files(spark, root):
    all_files = read_events(spark, root).inputFiles()
    assert len(all_files) >= 30
    assert len(TS.matching_files(spark, root, "marker-17'")) == 1
    assert TS.matching_files(spark, root, "no such text") == []
    assert len(TS.matching_files(spark, root, "orders")) == len(all_files)
    assert len(TS.matching_files(spark, root, "ab")) == len(all_files)  # too short for the index
    assert len(TS.matching_files(spark, root, "marker-17'", DAYS[:5])) == 0


def test_files_the_index_does_not_know_are_opened(spark, root, tmp_path):
    import shutil
    copy = str(tmp_path / "events")
    shutil.copytree(root, copy)
    row = list(event(DAYS[3], n=9999))
    row[COLS.index("query")] = "late marker-77"
    spark.createDataFrame([tuple(row)], EVENTS).write.mode("append").partitionBy("region", "day").parquet(copy)
    assert [r.query_id for r in TS.events_containing(spark, copy, "marker-77").collect()] == ["q9999"]
    TS.write_index(spark, copy, [DAYS[3]])  # one day is indexed anew
    assert len(TS.matching_files(spark, copy, "marker-77")) == 1
    assert len(TS.matching_files(spark, copy, "marker-4'")) == 1
    bare = str(tmp_path / "bare")
    shutil.copytree(root, bare, ignore=shutil.ignore_patterns(TS.INDEX))
    assert not os.path.exists(TS.index_root(bare))
    assert len(TS.events_containing(spark, bare, "marker-4'").collect()) == 1


def test_the_registered_search_opens_under_a_tenth(spark, tmp_path):
    import __spark_entry__ as E
    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("driver test data not present")
    where = str(tmp_path / "events")
    write_events(E._audit(spark, "/root/testdata/sf0.01"), where)
    TS.write_index(spark, where)
    found = TS.matching_files(spark, where, E.RARE_TEXT)
    assert 0 < len(found) < 0.1 * len(read_events(spark, where).inputFiles())
