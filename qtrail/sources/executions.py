"""S3 input: raw query-execution records as landed from the query service
(JSON lines, one record per line, any folder layout), plus a derived dump
built from the driver's ``events`` table for tests and registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail.schemas import EXECUTION
from qtrail.sources.derived import CANCELLED_REASON, FAILED_REASON, _base


def read_executions(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    """Execution records; ``region`` column from the argument or the
    ``region=`` folder of the dump."""
    schema = T.StructType(EXECUTION.fields + [T.StructField("region", T.StringType())])
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    if region is not None:
        df = df.withColumn("region", F.lit(region))
    return df.where(F.col("QueryExecutionId").isNotNull())


def derived_executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One execution record per driver ``events`` row. Some are still running
    or queued, some lack statistics or a submission time (then the completion
    time, a few minutes later and possibly on the next day, decides the day)."""
    b = _base(spark, sf_dir)
    eid, et = F.col("event_id"), F.col("event_type")
    state = (F.when((et == "click") & (eid % 6 == 0), F.lit("RUNNING"))
             .when((et == "purchase") & (eid % 6 == 1), F.lit("QUEUED"))
             .when(et == "error", F.lit("FAILED"))
             .when(eid % 10 == 1, F.lit("CANCELLED"))
             .otherwise(F.lit("SUCCEEDED")))
    reason = (F.when(state == "FAILED", F.lit(FAILED_REASON))
              .when(state == "CANCELLED", F.lit(CANCELLED_REASON)))
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
    submitted = F.when(eid % 13 == 0, F.lit(None).cast("string")).otherwise(F.date_format("ts", fmt))
    completed = F.date_format(F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), eid % 240), fmt)
    scanned = F.when((et == "view") & (eid % 4 == 0), F.lit(None).cast("long")).otherwise(
        F.floor(F.col("value") * F.lit(1e9)).cast("long"))
    return b.select(
        F.col("qid").alias("QueryExecutionId"),
        F.col("qt").alias("Query"),
        F.col("wg").alias("WorkGroup"),
        F.struct(scanned.alias("DataScannedInBytes")).alias("Statistics"),
        F.struct(state.alias("State"), reason.alias("StateChangeReason"),
                 submitted.alias("SubmissionDateTime"), completed.alias("CompletionDateTime")).alias("Status"),
        "region",
    )

