"""The enrichment join where one id holds half of all rows: the same rows as
the plain join, and no task with a large share of them."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from qtrail.config import AuditConfig
from qtrail.operators import enrich as EN
from tests.fixtures import history_df, history_row, trail_df, trail_row

CFG = AuditConfig(heavy_rows=50)


def rows_of(df):
    return Counter(map(str, df.collect()))


def inputs(spark, hot_trail, hot_history):
    rng = random.Random(4)
    trail = [trail_row("hot", text=f"SELECT {n % 3}") for n in range(hot_trail)]
    trail += [trail_row(f"q{rng.randrange(80)}", region=rng.choice(["us-east-1", "eu-west-1"])) for _ in range(300)]
    trail += [trail_row(None, with_response=False) for _ in range(20)]
    history = [history_row("hot", scanned=n) for n in range(hot_history)]
    history += [history_row(f"q{rng.randrange(120)}", region=rng.choice(["us-east-1", "eu-west-1"])) for _ in range(200)]
    history += [history_row(None, query="SELECT 9") for _ in range(10)]
    return trail_df(spark, trail).repartition(5), history_df(spark, history).repartition(4)


@pytest.mark.parametrize("hot_trail,hot_history", [(600, 0), (600, 1), (600, 3), (0, 600), (1, 600), (2, 600), (300, 60), (60, 300)])
def test_split_keys_give_the_rows_of_the_plain_join(spark, hot_trail, hot_history):
    trail, history = inputs(spark, hot_trail, hot_history)
    heavy = EN.heavy_keys(trail, history, CFG)
    key = "us-east-1\0" + "2024-01-02\0" + "hot"
    assert (heavy.trail, heavy.history) == (((key,), ()) if hot_trail >= hot_history else ((), (key,)))
    assert heavy.splits == -(-max(hot_trail, hot_history) // 50)
    assert rows_of(EN.staging(trail, history, CFG, heavy=heavy)) == rows_of(EN.staging(trail, history, CFG))
    strict = AuditConfig(heavy_rows=50, strict_not_in=True, keep_null_arn=True)
    assert rows_of(EN.staging(trail, history, strict, heavy=heavy)) == rows_of(EN.staging(trail, history, strict))


def test_no_task_holds_the_frequent_id(spark):
    trail, history = inputs(spark, 3000, 2)
    heavy = EN.heavy_keys(trail, history, CFG)

    def largest(df):
        return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]

    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        split, plain = largest(EN.staging(trail, history, CFG, heavy=heavy)), largest(EN.staging(trail, history, CFG))
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert plain >= 6000 and split <= 6000 / 4


def test_no_heavy_key_leaves_the_plan_alone(spark):
    trail, history = inputs(spark, 10, 2)
    heavy = EN.heavy_keys(trail, history, CFG)
    assert heavy == EN.HeavyKeys() == EN.heavy_keys(trail, history, AuditConfig(heavy_rows=0))
    plan = EN.staging(trail, history, CFG, heavy=heavy)._jdf.queryExecution().executedPlan().toString()
    assert "_split" not in plan
    assert EN.heavy_keys(trail.limit(0), history.limit(0), CFG) == EN.HeavyKeys()
