"""The enriched events table (Parquet, partitioned region/day)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from qtrail.schemas import EVENT_COLUMNS, EVENT_PARTITIONS, EVENTS
from qtrail.sources.trail import empty_or_raise, hive_glob


def read_events(spark: SparkSession, root: str, days=None, regions=None) -> DataFrame:
    """Declared schema: ``day`` stays a string, ``event_time`` zone-less.
    With ``days`` only those partition folders are listed (a glob under
    ``basePath``); predicates on ``day`` / ``region`` prune partitions
    either way."""
    glob = hive_glob(root, days, regions)
    if glob is None:
        return spark.read.schema(EVENTS).parquet(root)
    try:
        return spark.read.schema(EVENTS).option("basePath", root).parquet(glob)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return empty_or_raise(spark, root, EVENTS)
        raise


def write_events(df: DataFrame, root: str) -> None:
    """Replace exactly the (region, day) partitions present in ``df``; other
    days are left alone. Columns are selected by name in declared order, so
    positional writers can never swap values. The REBALANCE hint lets
    adaptive execution gather each partition's rows into few, evenly sized
    files and split an oversized (region, day) over several tasks, instead of
    every task writing a small file into every partition it holds rows for.
    (Builds publish whole versions instead: ``plans/publish.py``.)"""
    out = df.select(*EVENT_COLUMNS).hint("rebalance", *EVENT_PARTITIONS)
    (out.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*EVENT_PARTITIONS).parquet(root))
