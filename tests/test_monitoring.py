"""Scan anomalies, shared identities and failure rates on small series whose
answers are worked out in plain Python."""

import math
import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from qtrail.operators import monitoring as M
from qtrail.schemas import EVENTS

COLS = [f.name for f in EVENTS.fields]


def event(day, user="u", scanned=1, agent="a", ip="1", arn=None, status="SUCCEEDED", workgroup="wg", n=0):
    row = dict.fromkeys(COLS)
    row.update(query_id=f"q{n}", event_time=datetime(2024, 1, 1), source_identity=user, user_identity_arn=arn, user_agent=agent,
               source_ip=ip, data_scanned=scanned, cost=Decimal(0), region="r", day=day, status=status, workgroup=workgroup)
    return tuple(row[c] for c in COLS)


def events(spark, rows):
    return spark.createDataFrame(rows, EVENTS)


def day(n):
    return str(date(2024, 3, 1) + timedelta(days=n))


def plain_scores(rows, lo, hi, window=14, least=7, z=3.0):
    """(user, day) -> (queries, bytes, baseline days, reason)."""
    daily = defaultdict(lambda: [0, 0])
    start = date.fromisoformat(lo) - timedelta(days=window)
    for r in rows:
        user, d, b = r[COLS.index("source_identity")], date.fromisoformat(r[COLS.index("day")]), r[COLS.index("data_scanned")]
        if start <= d <= date.fromisoformat(hi):
            daily[user, d][0] += 1
            daily[user, d][1] += b
    out = {}
    for user in {u for u, _ in daily}:
        first = min(d for u, d in daily if u == user)
        d = first
        while d <= date.fromisoformat(hi):
            base = [daily.get((user, d - timedelta(days=k)), [0, 0])[1] for k in range(1, window + 1) if d - timedelta(days=k) >= first]
            q, b = daily.get((user, d), (0, 0))
            reason = None
            if len(base) >= least:
                mean = sum(base) / len(base)
                dev = math.sqrt(sum((x - mean) ** 2 for x in base) / len(base))
                if b - mean > z * dev + 1e-9 * (1 + mean):
                    reason = "spike" if dev > 0 else "above_constant" if mean > 0 else "after_silence"
            if d >= date.fromisoformat(lo):
                out[user, str(d)] = (q, b, len(base), reason)
            d += timedelta(days=1)
    return out


def test_scores_over_a_dense_series(spark):
    rows = [event(day(n), "steady", 100) for n in range(30)] + [event(day(25), "steady", 1)]       # constant, then a rise
    rows += [event(day(n), "spiky", 100 + n % 3) for n in range(0, 30, 2)] + [event(day(20), "spiky", 10**15)]
    rows += [event(day(2), "sleeper", 5), event(day(29), "sleeper", 7)]                              # silence, then a query
    rows += [event(day(27), "new", 5), event(day(29), "new", 10**9)]                                 # too short a history
    rows += [event(day(n), None, 3) for n in range(30)]                                             # no name: a series of its own
    want = plain_scores(rows, day(10), day(29))
    got = {(r.user_name, r.day): (r.queries, r.bytes, r.baseline_days, r.reason)
           for r in M.scan_scores(events(spark, rows), day(10), day(29)).collect()}
    assert got == want
    found = {(u, d): v[3] for (u, d), v in got.items() if v[3]}
    assert found[("steady", day(25))] == "above_constant"
    assert found[("spiky", day(20))] == "spike"
    assert found[("sleeper", day(29))] == "after_silence"
    assert not any(u in ("new", None) for u, _ in found)
    anomalies = M.scan_anomalies(events(spark, rows), day(10), day(29)).collect()
    assert {(r.user_name, r.day) for r in anomalies} == set(found)
    # A deviation of 0 has no score; a spike has one.
    assert all((r.z_score is None) == (r.reason != "spike") for r in anomalies)


def test_one_user_with_half_the_rows_is_one_row_a_day(spark):
    rng = random.Random(1)
    rows = [event(day(rng.randrange(28)), "hot" if n % 2 else f"u{n % 40}", rng.randrange(1, 1000), n=n) for n in range(4000)]
    df = events(spark, rows)
    got = {(r.user_name, r.day): (r.queries, r.bytes, r.baseline_days, r.reason)
           for r in M.scan_scores(df, day(14), day(27)).collect()}
    assert got == plain_scores(rows, day(14), day(27))
    plan = M.scan_scores(df, day(14), day(27))._jdf.queryExecution().executedPlan().toString()
    # Sums before the windows (partial ones before the shuffle), windows on one exchange by user.
    assert plan.count("HashAggregate") == 2
    assert sum("hashpartitioning(user_name" in line and "day" not in line for line in plan.splitlines()) == 1
    assert "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" not in plan


def test_scores_of_nothing(spark):
    none = M.scan_scores(events(spark, []), day(0), day(3))
    assert none.count() == 0 and none.columns[:2] == ["user_name", "day"]


def test_shared_identities_equal_exact_counts(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        agents, ips = rng.choice([1, 1, 1, 2, 3]), rng.choice([1, 5, 38, 39, 40, 41, 90])
        for n in range(ips):
            rows.append(event(day(n % 5), f"u{i}", agent=f"app{n % agents}", ip=f"ip{n}", arn=f"arn{i}", n=n))
    rows += [event(day(0), arn=None, agent=f"x{n}", ip=f"y{n}") for n in range(100)]
    rows += [event(day(1), arn="silent", agent=None, ip=None) for n in range(100)]
    rows += [event(day(9), arn="late", agent=f"x{n}", ip=f"y{n}") for n in range(100)]  # outside the range
    rows += [event(day(2), arn="hot", agent="one", ip=f"h{n % 700}", n=n) for n in range(5000)]
    df = events(spark, rows)
    root = str(tmp_path / "sketches")
    M.write_identity_sketches(df, root)
    stored = M.read_identity_sketches(spark, root, day(0), day(4))
    out = M.shared_identities(df, stored, day(0), day(4))
    got = {r.user_identity_arn: (r.queries, r.agents, r.ips) for r in out.collect()}
    seen = defaultdict(lambda: [0, set(), set()])
    for r in rows:
        arn, d = r[COLS.index("user_identity_arn")], r[COLS.index("day")]
        if arn and day(0) <= d <= day(4):
            seen[arn][0] += 1
            seen[arn][1].add(r[COLS.index("user_agent")])
            seen[arn][2].add(r[COLS.index("source_ip")])
    want = {a: (n, len(g - {None}), len(i - {None})) for a, (n, g, i) in seen.items()}
    assert got == {a: v for a, v in want.items() if v[1] >= 2 or v[2] >= 40}
    assert "hot" in got and "silent" not in got and "late" not in got
    plan = out._jdf.queryExecution().executedPlan().toString().lower()
    assert "distinct" not in plan and "hll" in plan


def test_sketches_are_replaced_by_day(spark, tmp_path):
    root = str(tmp_path / "sketches")
    M.write_identity_sketches(events(spark, [event(day(0), arn="a", agent="1"), event(day(1), arn="a", agent="2")]), root)
    M.write_identity_sketches(events(spark, [event(day(1), arn="b", agent="3")]), root)
    days = {(r.user_identity_arn, r.day) for r in M.read_identity_sketches(spark, root, day(0), day(5)).collect()}
    assert days == {("a", day(0)), ("b", day(1))}
    assert M.merged_identities(M.read_identity_sketches(spark, root, day(0), day(5))).where("user_agent_about = 1").count() == 2


@pytest.mark.parametrize("statuses,want", [(["FAILED", "SUCCEEDED", None], Decimal("0.3333")), (["FAILED"], Decimal("1.0000"))])
def test_failure_rate(spark, statuses, want):
    rows = [event(day(0), status=s) for s in statuses]
    [r] = M.failure_rate(events(spark, rows), F.col("day") == day(0)).collect()
    assert (r.total, r.failure_rate) == (len(statuses), want)
