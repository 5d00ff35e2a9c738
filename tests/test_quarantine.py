"""S1 on files as they come: one object, several, pretty-printed, cut off,
empty, or not JSON at all. No readable record is lost, the rest is counted."""

import gzip
import json
import os

import pytest

from qtrail.schemas import TRAIL
from qtrail.sources import trail as T
from qtrail.sources.trail import BadTrailParts, read_trail, set_aside, trail_quarantine
from tests.fixtures import GOLDEN_RECORD

DAY = "2024-03-03"


def put(root, name, text, region="us-east-1"):
    folder = os.path.join(root, region, *DAY.split("-"))
    os.makedirs(folder, exist_ok=True)
    opened = gzip.open if name.endswith(".gz") else open
    with opened(os.path.join(folder, name), "wt", newline="") as f:
        f.write(text)


def named(*ids):
    return {"Records": [{**GOLDEN_RECORD, "responseElements": {"queryExecutionId": i}} for i in ids]}


def ids(df):
    return sorted(json.loads(r.responseElements)["queryExecutionId"] for r in df.collect())


def flush_left(value):
    """Pretty-printed, without indentation."""
    return "\n".join(line.strip() for line in json.dumps(value, indent=1).splitlines())


FILES = {
    "one.json": (json.dumps(named("a1", "a2")), ["a1", "a2"], []),
    "one.json.gz": (json.dumps(named("b1")) + "\n", ["b1"], []),
    "pretty.json": (json.dumps(named("c1", "c2"), indent=2), ["c1", "c2"], []),
    "pretty-crlf.json": (json.dumps(named("d1", "d2"), indent=2).replace("\n", "\r\n") + "\r\n", ["d1", "d2"], []),
    "lines.json": ("\n".join(json.dumps(named(i)) for i in ("e1", "e2", "e3")), ["e1", "e2", "e3"], []),
    "many-pretty.json.gz": ("\n".join(json.dumps(named(i), indent=1) for i in ("f1", "f2")), ["f1", "f2"], []),
    "flush-left.json": (flush_left(named("g1", "g2")), ["g1", "g2"], []),
    "cut-off.json": (json.dumps(named("lost1", "lost2"))[:-30], [], ["corrupt"]),
    "cut-off-pretty.json": (json.dumps(named("lost3"), indent=2)[:-9], [], ["corrupt"]),
    "line-broken.json": ("\n".join([json.dumps(named("h1")), '{"Records": [{"eventTime": ', "", json.dumps(named("h2"))]),
                         ["h1", "h2"], ["corrupt"]),
    "first-broken.json": ("\n".join(['{"Records": [{"x": 1},', json.dumps(named("i1"))]), ["i1"], ["corrupt"]),
    "digest.json": ('{"digestStartTime": "2024"}', [], ["no_records"]),
    "text.json": ("not json", [], ["corrupt"]),
    "empty.json": ("", [], []),
    "blank.json": ("\n \n", [], []),
    "none.json": ('{"Records": []}', [], []),
}


def test_every_readable_record_and_every_broken_part(spark, tmp_path):
    for name, (text, _, _) in FILES.items():
        put(str(tmp_path), name, text)
    assert ids(read_trail(spark, str(tmp_path), days=[DAY])) == sorted(i for _, good, _ in FILES.values() for i in good)
    bad = trail_quarantine(spark, str(tmp_path), days=[DAY]).collect()
    got = sorted((os.path.basename(r.file), r.reason) for r in bad)
    assert got == sorted((n, why) for n, (_, _, reasons) in FILES.items() for why in reasons)
    assert all((r.region, r.day) == ("us-east-1", DAY) for r in bad)
    cut = next(r for r in bad if r.file.endswith("cut-off.json"))
    assert cut.text == FILES["cut-off.json"][0]  # whole, to be delivered again


@pytest.mark.parametrize("name", [n for n in FILES if not n.endswith("blank.json")])
def test_catalog_view_reads_the_same(spark, tmp_path, name):
    from qtrail.plans import tables as TB
    put(str(tmp_path / "t"), name, FILES[name][0])
    t = TB.TableSet("qtrail_quarantine", str(tmp_path), folders={"cloud_trail": str(tmp_path / "t")})
    spark.sql("DROP DATABASE IF EXISTS qtrail_quarantine CASCADE")
    try:
        TB.init_tables(spark, t)
        TB.add_trail_partitions(spark, t, [DAY], ["us-east-1"])
        assert ids(spark.table(t.name("cloud_trail"))) == FILES[name][1]
    finally:
        spark.sql("DROP DATABASE IF EXISTS qtrail_quarantine CASCADE")


def test_set_aside_counts_and_fails_above_its_limit(spark, tmp_path):
    root = str(tmp_path / "t")
    put(root, "good.json", json.dumps(named("a")))
    assert set_aside(spark, root, str(tmp_path / "q0"), [DAY], most=0) == 0
    put(root, "bad.json", "{")
    put(root, "worse.json", "{{")
    assert set_aside(spark, root, str(tmp_path / "q1"), [DAY]) == 2
    assert set_aside(spark, root, str(tmp_path / "q2"), [DAY], most=2) == 2
    with pytest.raises(BadTrailParts, match="2 unreadable.*bad.json"):
        set_aside(spark, root, str(tmp_path / "q3"), [DAY], most=1)
    assert spark.read.json(str(tmp_path / "q3")).count() == 2  # written aside all the same
    assert set_aside(spark, root, str(tmp_path / "q4"), ["2030-01-01"], most=0) == 0


def test_cli_quarantine(spark, tmp_path, capsys):
    from qtrail.__main__ import main
    from tests.fixtures import GOLDEN_HISTORY, write_history_file
    put(str(tmp_path / "t"), "bad.json", "{")
    put(str(tmp_path / "t"), "good.json", json.dumps({"Records": [GOLDEN_RECORD]}, indent=1))
    write_history_file(str(tmp_path / "h"), "us-east-1", DAY, "primary", GOLDEN_HISTORY)
    args = ["events", "--trail-root", str(tmp_path / "t"), "--history-root", str(tmp_path / "h"), "--events-root",
            str(tmp_path / "e"), "--day", DAY, "--quarantine", str(tmp_path / "q")]
    main(args)
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["unreadable"] == 1 and out["events"] == 2
    with pytest.raises(BadTrailParts):
        main([*args, "--max-bad", "0"])


@pytest.mark.parametrize("layout", ["hive", "native"])
def test_written_files_stay_small_however_large_a_day(spark, tmp_path, layout):
    most = T.FILE_RECORDS if layout == "hive" else 50 * T.FILE_OBJECTS
    n, root = most + 7, str(tmp_path / "t")
    one = spark.createDataFrame([{f.name: GOLDEN_RECORD.get(f.name) for f in TRAIL.fields} | {
        "requestParameters": "{}", "responseElements": "{}", "region": "us-east-1", "day": DAY}], TRAIL)
    rows = spark.range(n, numPartitions=1).crossJoin(one).drop("id")
    (T.write_trail if layout == "hive" else T.write_trail_delivery)(rows, root)
    held = [sum(len(json.loads(line)["Records"]) for line in gzip.open(f, "rt")) for f in (tmp_path / "t").rglob("*.json.gz")]
    assert sum(held) == n and max(held) <= most
    assert read_trail(spark, root, layout=layout).count() == n
    assert trail_quarantine(spark, root, layout=layout).count() == 0


def test_parts_are_rows_before_they_are_parsed(spark, tmp_path):
    put(str(tmp_path), "lines.json", "\n".join([*(json.dumps(named(f"i{i}")) for i in range(50)), '{"Records": [']))
    parts = T.trail_parts(spark, str(tmp_path))
    assert {f.name: f.dataType.simpleString() for f in parts.schema.fields}["text"] == "string"
    assert sorted(r.part for r in parts.collect()) == list(range(51))
    [bad] = trail_quarantine(spark, str(tmp_path)).collect()
    assert (bad.part, bad.reason, bad.text) == (50, "corrupt", '{"Records": [')
    assert ids(read_trail(spark, str(tmp_path))) == sorted(f"i{i}" for i in range(50))
