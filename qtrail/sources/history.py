"""Query-history JSON lines, partitioned ``region/day/workgroup``.

Reading declares the schema (partition columns as strings) so Spark prunes
partitions from ``day`` / ``region`` predicates and never infers dates. Bad
lines are tolerated: PERMISSIVE mode turns them into all-NULL rows, which the
``query_id IS NOT NULL`` filter removes (lines with a mistyped field keep
their other fields).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrail.functions import predicates as P
from qtrail.schemas import HISTORY, HISTORY_FILE, HISTORY_PARTITIONS
from qtrail.sources.trail import empty_or_raise, hive_glob


def read_history(spark: SparkSession, root: str, days=None, regions=None) -> DataFrame:
    """With ``days`` only those day folders are listed (a glob under
    ``basePath``), not the whole history tree."""
    glob = hive_glob(root, days, regions)
    reader = spark.read.schema(HISTORY).option("mode", "PERMISSIVE")
    try:
        df = reader.option("basePath", root).json(glob) if glob else reader.json(root)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return empty_or_raise(spark, root, HISTORY)
        raise
    return df.where(P.all_of(F.col("query_id").isNotNull(), P.in_days(days), P.in_regions(regions)))


def write_history(df: DataFrame, root: str) -> None:
    """Gzip JSON lines per region/day/workgroup. Dynamic overwrite replaces
    exactly the partitions present in ``df`` (``workgroup=a`` never touches
    ``workgroup=ab``); an empty result writes no file."""
    cols = [f.name for f in HISTORY_FILE.fields] + list(HISTORY_PARTITIONS)
    # REBALANCE: about one file per partition, oversized ones split by AQE.
    (df.select(*cols).hint("rebalance", *HISTORY_PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", "gzip").partitionBy(*HISTORY_PARTITIONS).json(root))
