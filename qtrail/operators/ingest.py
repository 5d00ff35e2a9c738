"""History ingest (X3 core): raw execution records -> history rows.

Keeps terminal states (F6), assigns each execution to the day of its
submission, else of its completion (P10), keeps the target days (F7) and
fills the defaults of the history row (P9). One job covers every region,
workgroup and day at once; the workgroup filter (F4) is a plain
case-insensitive substring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qtrail.functions import columns as X
from qtrail.functions import predicates as P
from qtrail.schemas import HISTORY


def history_rows(executions: DataFrame, days=None, workgroups_filter: str = "",
                 workgroup: str | None = None) -> DataFrame:
    """``workgroup`` names one workgroup exactly; the substring filter is then not used."""
    wanted = (P.workgroup_contains("WorkGroup", workgroups_filter) if workgroup is None
              else F.col("WorkGroup") == F.lit(workgroup))
    day = X.execution_day("Status.SubmissionDateTime", "Status.CompletionDateTime")
    e = executions.where(P.all_of(P.terminal_state("Status.State"), wanted))
    e = e.withColumn("_day", day).where(P.all_of(F.col("_day").isNotNull(), P.in_days(days, "_day")))
    out = e.select(
        F.col("QueryExecutionId").alias("query_id"),
        F.col("Query").alias("query"),
        X.bytes_or_zero("Statistics.DataScannedInBytes").alias("data_scanned"),
        F.col("Status.State").alias("status"),
        F.coalesce(F.col("Status.StateChangeReason"), F.lit("")).alias("state_change_reason"),
        F.coalesce(X.iso_time("Status.SubmissionDateTime"), F.lit("")).alias("submission_time"),
        F.col("region"),
        F.col("_day").alias("day"),
        F.col("WorkGroup").alias("workgroup"),
    )
    return out.select(*[f.name for f in HISTORY.fields])


def undated_executions(executions: DataFrame) -> DataFrame:
    """How many terminal executions carry no readable time and so reach no day."""
    day = X.execution_day("Status.SubmissionDateTime", "Status.CompletionDateTime")
    return executions.where(P.terminal_state("Status.State") & day.isNull()).agg(
        F.count(F.lit(1)).alias("undated"))


def history_run_report(history: DataFrame, days=None, workgroups=None) -> DataFrame:
    """A15 (history job): per day, workgroups and records. With ``days`` an
    empty day has a row of zeros. With ``workgroups`` -- rows (workgroup,
    readable), the service's listing -- the listed ones are counted, those
    that hold no record included, and those not readable are the skipped."""
    spark = history.sparkSession
    out = history.groupBy("day").agg(F.countDistinct("workgroup").alias("workgroups"),
                                     F.count(F.lit(1)).alias("records"))
    if days:
        wanted = spark.range(1).select(F.explode(F.array(*[F.lit(d) for d in days])).alias("day"))
        out = wanted.join(out, "day", "left")
    zero = F.lit(0).cast("long")
    if workgroups is None:
        return out.select("day", F.coalesce("workgroups", zero).alias("workgroups"),
                          zero.alias("skipped_workgroups"), F.coalesce("records", zero).alias("records"))
    # One row for all listed workgroups, so the join adds no rows.
    listed = workgroups.agg(F.countDistinct("workgroup").alias("_listed"),
                            F.countDistinct(F.when(~F.col("readable"), F.col("workgroup"))).alias("_skipped"))
    one = F.lit(1)
    return (out.withColumn("_one", one).join(listed.withColumn("_one", one), "_one")
            .select("day", F.col("_listed").alias("workgroups"), F.col("_skipped").alias("skipped_workgroups"),
                    F.coalesce("records", zero).alias("records")))
