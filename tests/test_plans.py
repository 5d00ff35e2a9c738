"""Plan shape: what the physical plans must (not) contain at scale."""

from qtrail.operators import classify as CL
from qtrail.operators import enrich as EN
from qtrail.plans.events_job import build_events
from qtrail.schemas import EVENT_COLUMNS
from qtrail.sources.derived import audit_inputs


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrichment_is_one_full_outer_shuffle_join(spark, sf_small):
    inp = audit_inputs(spark, sf_small)
    p = plan(EN.staging(inp.trail, inp.history))
    assert p.count("FullOuter") == 1
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_pass1_becomes_left_outer(spark, sf_small):
    inp = audit_inputs(spark, sf_small)
    p = plan(EN.pass1(inp.trail, inp.history))
    assert "LeftOuter" in p and "FullOuter" not in p


def test_history_only_is_an_anti_join_on_keys(spark, sf_small):
    inp = audit_inputs(spark, sf_small)
    p = plan(EN.history_only(inp.trail, inp.history))
    assert "LeftAnti" in p and "FullOuter" not in p


def test_tier_lookup_is_broadcast_and_no_nested_loops(spark, sf_small):
    inp = audit_inputs(spark, sf_small)
    p = plan(CL.classify(EN.staging(inp.trail, inp.history), inp.tiers))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_history_read_prunes_partitions(spark, tmp_path):
    from qtrail.sources.history import read_history
    from tests.fixtures import GOLDEN_HISTORY, write_history_file
    write_history_file(str(tmp_path), "us-east-1", "2024-03-03", "primary", GOLDEN_HISTORY)
    df = read_history(spark, str(tmp_path), days=["2024-03-03"], regions=["us-east-1"])
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in p or "PartitionFilters: [" in p
    assert "day#" in p.split("PartitionFilters:")[1].split("]")[0]


def test_reports_read_only_needed_columns(spark, tmp_path, sf_small):
    from qtrail.operators import reports as R
    from qtrail.sources.events import read_events, write_events
    inp = audit_inputs(spark, sf_small)
    write_events(CL.classify(EN.staging(inp.trail, inp.history), inp.tiers), str(tmp_path))
    df = R.workgroup_usage(read_events(spark, str(tmp_path)))
    p = plan(df)
    schema = p.split("ReadSchema:")[1].split("\n")[0]
    assert "query" not in schema and "workgroup" in schema and "cost" in schema


def test_events_build_has_no_python_and_shuffles_wide_rows_once(spark, sf_small):
    from qtrail.plans.events_job import staged
    inp = audit_inputs(spark, sf_small)
    joins = EN.staging(inp.trail, inp.history)
    out = CL.classify(staged(joins), inp.tiers)
    p = plan(out)
    for word in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "Window", "posexplode"):
        assert word not in p and word not in plan(joins)
    hashed = [l for l in plan(joins).splitlines() if "Exchange hashpartitioning" in l]
    assert len(hashed) == 2  # trail starts and history on (region, day, key)
    # After the staging, exchanges carry sets of tables or (day, id): the wide rows stay where they are read.
    wide = [n for n in p.split("Exchange hashpartitioning")[1:] if "state_change_reason" in n.split("Exchange")[0].split("FileScan")[0]]
    assert not wide


def test_a_frequent_id_needs_no_window_or_sort(spark):
    """Half of the rows under one id: classified as a plain statement says."""
    from qtrail.sources.tiers import tiers_from_rows
    from tests.fixtures import history_df, trail_df, trail_row
    rows = [trail_row("hot" if n % 2 else f"q{n}", text=f"SELECT * FROM t{n % 5}", region=f"r{n % 3}") for n in range(400)]
    tiers = tiers_from_rows(spark, [("db", "t1", "tier_2"), ("db", "t3", "tier_1")])
    out = CL.classify(EN.staging(trail_df(spark, rows), history_df(spark, [])), tiers)
    got = {(r.query_id, r.query, r.classification_tier) for r in out.collect()}
    own = {"SELECT * FROM t1": "tier_2", "SELECT * FROM t3": "tier_1"}
    want = {("hot", f"SELECT * FROM t{n % 5}", "tier_1") for n in range(1, 400, 2)}
    want |= {(f"q{n}", f"SELECT * FROM t{n % 5}", own.get(f"SELECT * FROM t{n % 5}")) for n in range(0, 400, 2)}
    assert got == want
    p = plan(out)
    assert "Window" not in p and "SortMergeJoin" not in p.split("AdaptiveSparkPlan")[0]


def test_a_build_searches_texts_once(spark, sf_small):
    inp = audit_inputs(spark, sf_small)
    out = build_events(inp.trail, inp.history, inp.tiers)
    # The tables named stand in the written staging; its three reads search no text.
    assert "regexp_extract_all" not in out._jdf.queryExecution().optimizedPlan().toString()
    key = ["query_id", "day", "classification_tier"]
    want = CL.classify(EN.staging(inp.trail, inp.history), inp.tiers).select(*key)
    assert out.select(*key).exceptAll(want).count() == want.exceptAll(out.select(*key)).count() == 0
    assert out.columns == list(EVENT_COLUMNS)
