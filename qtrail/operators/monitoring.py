"""Monitoring of users over the enriched events: unusual scan volumes
(``scan_scores`` / ``scan_anomalies``), identities that several applications
share (``identity_sketches`` / ``shared_identities``) and failure rates.

All three start from a group-by with map-side partial aggregation, so what is
shuffled is one row per user (or identity) and day and task, and a user with
half of all rows costs each task one row a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail import config as C
from qtrail.functions import columns as X
from qtrail.functions import predicates as P
from qtrail.functions.calendar import day_range_start

# -- scan volumes ------------------------------------------------------------
SPIKE, ABOVE_CONSTANT, AFTER_SILENCE = "spike", "above_constant", "after_silence"


def daily_scans(events: DataFrame) -> DataFrame:
    """``user_name, day, queries, bytes``: one row per user and day with queries."""
    return events.groupBy(X.user_name().alias("user_name"), "day").agg(
        F.count(F.lit(1)).alias("queries"), F.sum("data_scanned").alias("bytes"))


def scan_scores(events: DataFrame, from_day: str, to_day: str, window_days: int = C.BASELINE_DAYS,
                least_days: int = C.BASELINE_LEAST_DAYS, z: float = C.ANOMALY_Z) -> DataFrame:
    """Every user and day of the range beside the user's trailing baseline.

    The series of a user is dense: it runs from the user's first day with a
    query (of the range and the ``window_days`` before it) to ``to_day``, and a
    day without queries has 0 bytes. The baseline of a day is the
    ``window_days`` calendar days before it, as far as the series reaches:
    ``baseline_days`` of them, their mean and their (population) deviation. A
    baseline under ``least_days`` is too short to judge: ``z_score`` and
    ``reason`` are NULL. A day stands out where its bytes exceed the mean by
    more than ``z`` deviations; ``reason`` then says ``spike``, or for a
    deviation of 0 ``above_constant`` (any rise over a constant series) or
    ``after_silence`` (a baseline of zeros), and ``z_score`` is NULL there.

    One shuffle by (user, day) for the sums and one by user for the series;
    filling the gaps and the baseline reuse the latter. A user has one row a
    day in it, whatever the number of queries. Sums are exact decimals."""
    start = day_range_start(from_day, window_days)
    daily = daily_scans(events.where(P.day_between(start, to_day)))
    by_user = Window.partitionBy("user_name").orderBy("_d")
    last = F.unix_date(F.to_date(F.lit(to_day)))
    dense = (daily.withColumn("_d", F.unix_date(F.to_date("day")))
             .withColumn("_until", F.coalesce(F.lead("_d").over(by_user) - 1, last))
             .select("user_name", F.col("_d").alias("_at"), "queries", "bytes",
                     F.explode(F.sequence("_d", "_until")).alias("_d")))
    held = F.col("_d") == F.col("_at")
    wide = T.DecimalType(38, 0)
    dense = dense.select("user_name", "_d", F.when(held, F.col("queries")).otherwise(F.lit(0)).alias("queries"),
                         F.when(held, F.col("bytes")).otherwise(F.lit(0)).cast(T.LongType()).alias("bytes"))
    # By date, not by row.
    trailing = by_user.rangeBetween(-window_days, -1)
    x = F.col("bytes").cast(T.DecimalType(19, 0))
    n = F.count(F.lit(1)).over(trailing)
    scored = dense.select(
        "user_name", "_d", "queries", "bytes", n.alias("_n"),
        F.coalesce(F.sum(x).over(trailing), F.lit(0)).cast(wide).alias("_s"),
        F.coalesce(F.sum((x * x).cast(wide)).over(trailing), F.lit(0)).cast(wide).alias("_q"))
    # n times the mean, and n times the deviation; exact up to the square root.
    spread = F.sqrt((F.col("_n") * F.col("_q") - F.col("_s") * F.col("_s")).cast("double"))
    above = (F.col("_n") * F.col("bytes").cast(wide) - F.col("_s")).cast("double")
    judged = F.col("_n") >= least_days
    reason = F.when(judged & (above > F.lit(float(z)) * spread),
                    F.when(spread > 0, F.lit(SPIKE)).when(F.col("_s") > 0, F.lit(ABOVE_CONSTANT))
                    .otherwise(F.lit(AFTER_SILENCE)))
    two = T.DecimalType(28, 2)
    out = scored.select(
        "user_name", F.date_format(F.date_from_unix_date("_d"), "yyyy-MM-dd").alias("day"), "queries", "bytes",
        F.col("_n").cast("int").alias("baseline_days"),
        F.when(F.col("_n") > 0, F.col("_s").cast("double") / F.col("_n")).cast(two).alias("baseline_bytes"),
        F.when(F.col("_n") > 0, spread / F.col("_n")).cast(two).alias("deviation_bytes"),
        F.when(judged & (spread > 0), above / spread).cast(T.DecimalType(18, 3)).alias("z_score"),
        reason.alias("reason"))
    return out.where(F.col("day") >= F.lit(from_day))


def scan_anomalies(events: DataFrame, from_day: str, to_day: str, **knobs) -> DataFrame:
    """The rows of ``scan_scores`` that stand out."""
    return scan_scores(events, from_day, to_day, **knobs).where(F.col("reason").isNotNull())


def failure_rate(events: DataFrame, pred: Column | None = None) -> DataFrame:
    """Failed and all queries by workgroup and day, and their ratio."""
    rows = events.where(pred) if pred is not None else events
    total, failed = F.count(F.lit(1)), F.count(F.when(F.col("status") == "FAILED", 1))
    return rows.groupBy("workgroup", "day").agg(
        total.alias("total"), failed.alias("failed"),
        F.round(failed.cast(T.DecimalType(20, 0)) / total, 4).cast(T.DecimalType(18, 4)).alias("failure_rate"))


# -- identities shared by applications ---------------------------------------
SKETCHED = ("user_agent", "source_ip")
SKETCH_SCHEMA = T.StructType([
    T.StructField("user_identity_arn", T.StringType()), T.StructField("queries", T.LongType()),
    *[T.StructField(f"{c}_sketch", T.BinaryType()) for c in SKETCHED], T.StructField("day", T.StringType())])


def identity_sketches(events: DataFrame) -> DataFrame:
    """One row per identity and day: queries, and a mergeable distinct-count
    sketch of the applications (``user_agent``) and addresses seen. A sketch
    has a fixed size (``2 ** SKETCH_LOG2`` registers at most); rows without an
    identity are left out."""
    return events.where(F.col("user_identity_arn").isNotNull()).groupBy("user_identity_arn", "day").agg(
        F.count(F.lit(1)).alias("queries"),
        *[F.hll_sketch_agg(c, F.lit(C.SKETCH_LOG2)).alias(f"{c}_sketch") for c in SKETCHED])


def write_identity_sketches(events: DataFrame, root: str) -> None:
    """Store the sketches of the days in ``events`` (whole days), replacing
    those days alone."""
    (identity_sketches(events).select(*[f.name for f in SKETCH_SCHEMA.fields]).hint("rebalance", "day")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(root))


def read_identity_sketches(spark: SparkSession, root: str, from_day: str, to_day: str) -> DataFrame:
    return spark.read.schema(SKETCH_SCHEMA).parquet(root).where(P.day_between(from_day, to_day))


def merged_identities(sketches: DataFrame) -> DataFrame:
    """Estimates over all days of ``sketches``: no event is read."""
    return sketches.groupBy("user_identity_arn").agg(
        F.sum("queries").alias("queries"),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"{c}_about") for c in SKETCHED])


def shared_identities(events: DataFrame, sketches: DataFrame, from_day: str, to_day: str,
                      least_agents: int = C.SHARED_AGENTS, least_ips: int = C.SHARED_IPS) -> DataFrame:
    """Identities with at least ``least_agents`` applications or ``least_ips``
    addresses in the range, with exact counts.

    The stored sketches of the range choose the identities whose estimate
    comes within ``SKETCH_MARGIN`` of a threshold; only the events of those
    are read into the exact count. With 4,096 registers the standard error is
    1.6 % (next to none below a few hundred values), so the margin is over
    twelve of them: an identity at a threshold is not lost. The exact count
    groups by (identity, value) first, so no task holds an identity's values."""
    near = 1 - C.SKETCH_MARGIN
    about = merged_identities(sketches.where(P.day_between(from_day, to_day)))
    chosen = about.where((F.col("user_agent_about") >= least_agents * near)
                         | (F.col("source_ip_about") >= least_ips * near)).select("user_identity_arn")
    rows = events.where(P.day_between(from_day, to_day)).join(chosen, "user_identity_arn", "left_semi")
    # A value of either kind is a row, NULL values counting as none.
    kind = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in SKETCHED]))
    values = (rows.select("user_identity_arn", kind.alias("v")).groupBy("user_identity_arn", "v.kind", "v.value")
              .agg(F.count(F.lit(1)).alias("n")))

    def distinct(c: str) -> Column:
        return F.count(F.when((F.col("kind") == c) & F.col("value").isNotNull(), 1))

    counted = values.groupBy("user_identity_arn").agg(
        F.sum(F.when(F.col("kind") == SKETCHED[0], F.col("n"))).alias("queries"),
        distinct("user_agent").alias("agents"), distinct("source_ip").alias("ips"))
    return counted.where((F.col("agents") >= least_agents) | (F.col("ips") >= least_ips))
