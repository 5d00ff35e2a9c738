from pyspark.sql import functions as F

from qtrail.operators import reports as R
from qtrail.sources.derived import TIER_ROWS
from qtrail.sources.events import read_events
from qtrail.sources.history import read_history
from qtrail.sources.tiers import tiers_from_rows
from qtrail.streaming.trail_watch import _spans, watch_trail
from tests.fixtures import GOLDEN_HISTORY, GOLDEN_QID, GOLDEN_RECORD, write_history_file, write_trail_file


def test_spans():
    assert _spans(["2024-01-01", "2024-01-02", "2024-01-05"]) == [("2024-01-01", "2024-01-02"),
                                                                   ("2024-01-05", "2024-01-05")]


def test_watch_rebuilds_touched_days(spark, tmp_path):
    trail, hist, ev = str(tmp_path / "t"), str(tmp_path / "h"), str(tmp_path / "e")
    write_trail_file(trail, "us-east-1", "2024-03-03", [GOLDEN_RECORD])
    write_history_file(hist, "us-east-1", "2024-03-03", "primary", GOLDEN_HISTORY)
    tiers = tiers_from_rows(spark, TIER_ROWS)
    q = watch_trail(spark, trail, lambda d: read_history(spark, hist, days=d), tiers, ev,
                    str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    rows = read_events(spark, ev).collect()
    assert {r.query_id for r in rows} >= {GOLDEN_QID}
    # A late file for another day: only that day is built on the next run.
    write_trail_file(trail, "us-east-1", "2024-03-04", [GOLDEN_RECORD], name="late.json")
    q = watch_trail(spark, trail, lambda d: read_history(spark, hist, days=d), tiers, ev,
                    str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    days = sorted(r.day for r in read_events(spark, ev).select("day").distinct().collect())
    assert days == ["2024-03-03", "2024-03-04"]


def test_adhoc_sql_and_view(spark, sf_small):
    import __spark_entry__ as E
    ev = E._audit(spark, sf_small)
    out = R.adhoc_sql(ev, "SELECT status, COUNT(*) AS cnt FROM events GROUP BY status")
    assert out.agg(F.sum("cnt")).first()[0] == ev.count()
    R.create_audit_report_view(ev)
    assert spark.table("audit_report").columns[0] == "Timestamp"
