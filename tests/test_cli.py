import json

from qtrail.session import cluster_conf
from tests.fixtures import GOLDEN_HISTORY, GOLDEN_RECORD, write_history_file, write_trail_file


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(100 * 2 ** 40, 8000)          # 100 TB on 8,000 cores
    assert c["spark.sql.shuffle.partitions"] == "409600"
    small = cluster_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_cli_events_and_report(spark, tmp_path, capsys):
    from qtrail.__main__ import main
    write_trail_file(str(tmp_path / "t"), "us-east-1", "2024-03-03", [GOLDEN_RECORD])
    write_history_file(str(tmp_path / "h"), "us-east-1", "2024-03-03", "primary", GOLDEN_HISTORY)
    main(["events", "--trail-root", str(tmp_path / "t"), "--history-root", str(tmp_path / "h"),
          "--events-root", str(tmp_path / "e"), "--day", "2024-03-03", "--input-bytes", str(1 << 20)])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == {"from_day": "2024-03-03", "to_day": "2024-03-03", "events": 2, "classified": 0}
    main(["report", "status_breakdown", "--events-root", str(tmp_path / "e"), "--csv", str(tmp_path / "csv")])
    rows = spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()
    assert {(r.status, r.cnt) for r in rows} == {("UNKNOWN", "2")}


def test_cli_every_report_runs(spark, sf_small, tmp_path, capsys):
    import __spark_entry__ as E
    from qtrail.__main__ import REPORTS, main
    from qtrail.sources.events import write_events
    root = str(tmp_path / "events")
    write_events(E._audit(spark, sf_small), root)
    for name in REPORTS:
        args = ["report", name, "--events-root", root, "--from", "2024-01-01", "--to", "2024-01-31",
                "--as-of", "2024-01-31", "--show", "1"]
        if name in ("unused_grants", "grant_usage"):
            (tmp_path / "grants.csv").write_text("principal,catalog,db,tbl,privileges\nuser1,,sales,*,SELECT\n")
            args += ["--grants-table", str(tmp_path / "grants.csv")]
        if name == "sql":
            args += ["--sql", "SELECT count(1) AS n FROM events"]
        main(args)
    out = capsys.readouterr().out
    assert out.count("+") > len(REPORTS)  # every report printed a table
