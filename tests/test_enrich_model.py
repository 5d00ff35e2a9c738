"""Enrichment against a brute-force statement of the original semantics
(LEFT JOIN for pass 1, NOT EXISTS / per-(region, day) NOT IN for pass 2) on
random small inputs with duplicate and NULL ids."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from qtrail.config import QUERY_SERVICE_SOURCE, REDACTED_QUERY_TEXT, SELF_ROLE_MARKERS, AuditConfig
from qtrail.operators import enrich as EN
from tests.fixtures import history_df, history_row, trail_df, trail_row

IDS = st.sampled_from(["a", "b", "c", None])
REGIONS = st.sampled_from(["r1", "r2"])
DAYS = st.sampled_from(["2024-01-01", "2024-01-02"])

trail_rows = st.lists(st.tuples(
    IDS, REGIONS, DAYS,
    st.sampled_from(["arn:u", None, f"arn:x/{SELF_ROLE_MARKERS[0]}"]),
    st.sampled_from(["SELECT t", REDACTED_QUERY_TEXT]),
    st.sampled_from([QUERY_SERVICE_SOURCE, "other.example"]),
    st.sampled_from(["StartQueryExecution", "GetQueryExecution"]),
), max_size=8)
history_rows = st.lists(st.tuples(IDS, REGIONS, DAYS, st.sampled_from(["SELECT h", None]),
                                  st.integers(0, 5)), max_size=8)


def model(trail, history, strict):
    starts = [t for t in trail if t[5] == QUERY_SERVICE_SOURCE and t[6] == "StartQueryExecution"]
    out = []
    for qid, reg, day, arn, text, _, _ in starts:
        hs = [h for h in history if qid is not None and h[0] == qid and h[1] == reg and h[2] == day] or [None]
        for h in hs:
            q = h[3] if h is not None and h[3] is not None else (None if text == REDACTED_QUERY_TEXT else text)
            if arn is None or any(m in arn for m in SELF_ROLE_MARKERS) or q is None:
                continue
            out.append(("p1", qid, reg, day, q, h[4] if h is not None else 0))
    for hq, reg, day, q, scanned in history:
        if q is None:
            continue
        same = [s[0] for s in starts if s[1] == reg and s[2] == day]
        if strict:
            keep = not same or (None not in same and hq is not None and hq not in same)
        else:
            keep = not any(s is not None and s == hq for s in same)
        if keep:
            out.append(("p2", hq, reg, day, q, scanned))
    return Counter(out)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(trail_rows, history_rows, st.booleans())
def test_enrichment_matches_model(spark, trail, history, strict):
    tdf = trail_df(spark, [trail_row(q, region=r, day=d, arn=a, text=t, source=src, name=n,
                                     with_response=q is not None) for q, r, d, a, t, src, n in trail])
    hdf = history_df(spark, [history_row(q, query=txt, scanned=b, region=r, day=d) for q, r, d, txt, b in history])
    got = EN.joined(tdf, hdf, AuditConfig(strict_not_in=strict)).collect()
    spark_rows = Counter(("p1" if r.from_trail else "p2", r.query_id, r.region, r.day, r.query, r.data_scanned)
                         for r in got)
    assert spark_rows == model(trail, history, strict)
