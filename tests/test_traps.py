"""Semantic traps T1-T25 of SURVEY §2.12, each on a hand-made fixture."""

from decimal import ROUND_HALF_UP, Decimal

import pytest

from qtrail.config import QUERY_SERVICE_SOURCE, SELF_ROLE_MARKERS, AuditConfig
from qtrail.functions import columns as X
from qtrail.functions.calendar import day_range_df, days_between
from qtrail.operators import classify as CL
from qtrail.operators import enrich as EN
from qtrail.sources.tiers import tiers_from_rows
from tests.fixtures import history_df, history_row, trail_df, trail_row

D = "2024-01-02"


def ids(df):
    return sorted(r.query_id for r in df.select("query_id").collect())


def test_t1_not_in_with_null_id_empties_pass2_for_that_region_day(spark):
    trail = trail_df(spark, [
        trail_row("a"), trail_row(None, with_response=False),            # NULL id on us-east-1 / D
        trail_row("c", region="eu-west-1"),                              # other region, no NULL
    ])
    hist = history_df(spark, [
        history_row("a"), history_row("h1"), history_row("h2"),
        history_row("h3", region="eu-west-1"),
        history_row("h4", day="2024-01-03"),                             # day without any start
    ])
    lenient = EN.history_only(trail, hist)
    strict = EN.history_only(trail, hist, AuditConfig(strict_not_in=True))
    assert ids(lenient) == ["h1", "h2", "h3", "h4"]
    assert ids(strict) == ["h3", "h4"]


def test_t1_null_history_id(spark):
    trail = trail_df(spark, [trail_row("a")])
    hist = history_df(spark, [history_row(None), history_row(None, day="2024-01-05")])
    strict = EN.history_only(trail, hist, AuditConfig(strict_not_in=True))
    # NULL NOT IN (non-empty set) drops; NOT IN (empty set) keeps.
    assert [r.day for r in strict.collect()] == ["2024-01-05"]
    assert EN.history_only(trail, hist).count() == 2


def test_t2_null_arn_dropped_and_not_resurrected(spark):
    trail = trail_df(spark, [trail_row("a", arn=None), trail_row("b", arn=f"arn:x/{SELF_ROLE_MARKERS[0]}-1"),
                             trail_row("c")])
    hist = history_df(spark, [history_row("a"), history_row("b"), history_row("c")])
    st = EN.staging(trail, hist)
    assert ids(st) == ["c"]
    kept = EN.staging(trail, hist, AuditConfig(keep_null_arn=True))
    assert ids(kept) == ["a", "c"]


def test_t3_cost_exact_and_overflow(spark):
    df = spark.createDataFrame([(0,), (1099511627776,), (123456789,), (None,)], "b long")
    got = [r.c for r in df.select(X.cost(X.bytes_or_zero("b")).alias("c")).collect()]
    exact = [(Decimal(b or 0) / Decimal(2 ** 40) * 5).quantize(Decimal("1e-8"), ROUND_HALF_UP)
             for b in (0, 1099511627776, 123456789, None)]
    assert got == exact and got[1] == Decimal("5.00000000")
    big = spark.createDataFrame([(2 ** 40 * 2000,)], "b long")
    with pytest.raises(Exception):
        big.select(X.cost("b")).collect()


def test_t5_iso_time_keeps_wall_time_and_empty_is_null(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00+02:00",), ("",), ("2024-01-01T00:00:07.179575+00:00",)], "t string")
    got = [r.e for r in df.select(X.event_time("t").alias("e")).collect()]
    assert str(got[0]) == "2024-01-01 10:00:00" and got[1] is None
    assert str(got[2]) == "2024-01-01 00:00:07.179575"


def _tiers(spark, rows=(("db", "t1", "tier_2"), ("db", "t2", "tier_1"))):
    return tiers_from_rows(spark, rows)


def test_t6_duplicate_ids_share_the_smallest_tier(spark):
    trail = trail_df(spark, [trail_row("a", text="SELECT * FROM t1"),
                             trail_row("a", text="SELECT * FROM t2", region="eu-west-1"),
                             trail_row("b", text="SELECT 1")])
    ev = CL.classify(EN.staging(trail, history_df(spark, [])), _tiers(spark))
    got = sorted((r.query_id, r.region, r.classification_tier) for r in ev.collect())
    assert got == [("a", "eu-west-1", "tier_1"), ("a", "us-east-1", "tier_1"), ("b", "us-east-1", None)]


def test_t7_tier_order_is_string_order(spark):
    trail = trail_df(spark, [trail_row("a", text="SELECT * FROM t1 JOIN t2 ON 1=1")])
    ev = CL.classify(EN.staging(trail, history_df(spark, [])),
                     _tiers(spark, (("db", "t1", "tier_10"), ("db", "t2", "tier_2"))))
    assert ev.first().classification_tier == "tier_10"


def test_t9_declared_column_order(spark):
    from qtrail.schemas import EVENT_COLUMNS
    ev = CL.classify(EN.staging(trail_df(spark, [trail_row("a")]), history_df(spark, [])), _tiers(spark))
    assert tuple(ev.columns) == EVENT_COLUMNS


def test_t10_day_stays_string_on_read_back(spark, tmp_path):
    from qtrail.sources.events import read_events, write_events
    ev = CL.classify(EN.staging(trail_df(spark, [trail_row("a")]), history_df(spark, [])), _tiers(spark))
    write_events(ev, str(tmp_path))
    assert dict(read_events(spark, str(tmp_path)).dtypes)["day"] == "string"
    assert dict(spark.read.parquet(str(tmp_path)).dtypes)["day"] == "string"


def test_t11_reversed_day_range(spark):
    with pytest.raises(ValueError):
        days_between("2024-01-05", "2024-01-01")
    assert days_between("2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert [r.day for r in day_range_df(spark, "2024-02-28", "2024-03-01").collect()] == \
        ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_t12_malformed_history_lines(spark, tmp_path):
    from qtrail.sources.history import read_history
    from tests.fixtures import write_history_file
    write_history_file(str(tmp_path), "r1", D, "w", [
        {"query_id": "ok", "query": "SELECT 1", "data_scanned": 1},
        "{not json at all",
        {"query_id": "typed", "query": "SELECT 2", "data_scanned": "7"},
    ])
    rows = {r.query_id: r for r in read_history(spark, str(tmp_path)).collect()}
    assert set(rows) == {"ok", "typed"}
    assert rows["typed"].query == "SELECT 2"


def test_t14_trail_keys_are_case_sensitive(spark, tmp_path):
    from qtrail.sources.trail import read_trail
    from tests.fixtures import write_trail_file
    rec = {"eventSource": QUERY_SERVICE_SOURCE, "sourceIpAddress": "9.9.9.9", "sourceIPAddress": "1.1.1.1",
           "userIdentity": {"principalid": "lower", "principalId": "UPPER"}}
    write_trail_file(str(tmp_path), "r1", D, [rec])
    r = read_trail(spark, str(tmp_path)).first()
    assert r.sourceIPAddress == "1.1.1.1" and r.userIdentity.principalId == "UPPER"


def test_t17_only_requested_regions(spark):
    trail = trail_df(spark, [trail_row("a"), trail_row("b", region="eu-west-1")])
    st = EN.staging(trail, history_df(spark, []), regions=["eu-west-1"])
    assert ids(st) == ["b"]


def test_t18_redacted_text_without_history_is_dropped(spark):
    trail = trail_df(spark, [trail_row("a", text="***OMITTED***"), trail_row("b", text="***OMITTED***")])
    hist = history_df(spark, [history_row("b", query="SELECT 42")])
    st = EN.staging(trail, hist).collect()
    assert [(r.query_id, r.query) for r in st] == [("b", "SELECT 42")]


def test_t20_database_fallback(spark):
    tiers = tiers_from_rows(spark, [("sales", "orders", "tier_2"), ("default", "orders", "tier_3")])
    trail = trail_df(spark, [trail_row("a", text="SELECT * FROM orders", database="sales"),
                             trail_row("b", text="SELECT * FROM orders", database="")])
    hist = history_df(spark, [history_row("h", query="SELECT * FROM orders")])
    ev = CL.classify(EN.staging(trail, hist), tiers)
    got = sorted((r.query_id, r.classification_tier) for r in ev.collect())
    assert got == [("a", "tier_2"), ("b", "tier_3"), ("h", "tier_3")]


def test_t21_case_sensitivity(spark):
    tiers = tiers_from_rows(spark, [("db", "orders", "tier_1")])
    trail = trail_df(spark, [trail_row("a", text="SELECT * FROM DB.Orders")])
    st = EN.staging(trail, history_df(spark, []))
    assert CL.classify(st, tiers).first().classification_tier is None
    ci = AuditConfig(tiers_case_insensitive=True)
    assert CL.classify(st, tiers, ci).first().classification_tier == "tier_1"


def test_t22_no_tiers(spark):
    st = EN.staging(trail_df(spark, [trail_row("a", text="SELECT * FROM db.t1")]), history_df(spark, []))
    ev = CL.classify(st, tiers_from_rows(spark, []))
    assert ev.count() == 1 and ev.first().classification_tier is None


def test_t8_workgroup_filter_is_plain_substring(spark):
    trail = trail_df(spark, [trail_row("a", workgroup="Team_A"), trail_row("b", workgroup="TeamXA")])
    hist = history_df(spark, [history_row("h", workgroup="team_a-etl")])
    st = EN.staging(trail, hist, AuditConfig(workgroups_filter=" TEAM_A "))
    assert ids(st) == ["a", "h"]


def test_tier_join_without_broadcast_matches_broadcast(spark):
    trail = trail_df(spark, [trail_row(f"q{i}", text=f"SELECT * FROM t{i % 3} JOIN db.t{(i + 1) % 3} ON 1=1")
                             for i in range(60)])
    st = EN.staging(trail, history_df(spark, []))
    tiers = _tiers(spark, (("db", "t0", "tier_3"), ("db", "t1", "tier_2"), ("db", "t2", "tier_1")))
    a = sorted(map(tuple, CL.classify(st, tiers).select("query_id", "classification_tier").collect()))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(n, None) for n in names]
    try:
        for n in names:
            spark.conf.set(n, "-1")
        b = sorted(map(tuple, CL.classify(st, tiers).select("query_id", "classification_tier").collect()))
    finally:
        for n, v in zip(names, before):
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    assert a == b and any(t is not None for _, t in a)


def test_t4_request_fields_one_parse_match_get_json_object(spark):
    texts = ['{"queryString":"SELECT 1","queryExecutionContext":{"database":"db"},"workGroup":"wg"}',
             '{"queryString":{"nested":1},"workGroup":7}', '{not json', None, '{}',
             '{"queryExecutionContext":null,"queryString":null}']
    df = spark.createDataFrame([(t,) for t in texts], "r string")
    one = df.select(X.trail_request("r").alias("q")).select("q.queryString", "q.queryExecutionContext.database",
                                                         "q.workGroup").collect()
    three = df.select(X.trail_query_string("r"), X.trail_database("r"), X.trail_workgroup("r")).collect()
    assert [tuple(a) for a in one] == [tuple(b) for b in three]


def test_duplicate_tier_keys_do_not_duplicate_events(spark):
    trail = trail_df(spark, [trail_row("a", text="SELECT * FROM t1"), trail_row("b", text="SELECT 1")])
    tiers = _tiers(spark, (("db", "t1", "tier_3"), ("db", "t1", "tier_2"), ("db", "t1", "tier_2")))
    ev = CL.classify(EN.staging(trail, history_df(spark, [])), tiers)
    assert sorted((r.query_id, r.classification_tier) for r in ev.collect()) == [("a", "tier_2"), ("b", None)]


def test_t23_force_recreate_range_ignores_day():
    from datetime import date
    from qtrail.functions.calendar import day_back, yesterday
    from qtrail.plans.events_job import range_for
    assert range_for(True, "2020-01-01") == (day_back(14), yesterday())
    assert range_for(False, "2020-01-01") == ("2020-01-01", "2020-01-01")
    assert range_for(False) == (yesterday(), yesterday())
    assert day_back(1, date(2024, 3, 1)) == "2024-02-29"
