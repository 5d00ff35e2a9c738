"""F8 text search that opens only files that can match.

Beside the events lies an index: for each data file, which trigrams (three
characters in a row) its lower-cased query texts hold, as a bitmap of
``2 ** BITS_LOG2`` hashed positions in blocks of 32,768 bits (4 KB; blocks
without a trigram have no row). A text occurs only in files that have all of
its trigrams; those are opened, and the exact test decides. A file that the
index does not know is opened as well, so a missing or late index costs time
and no row.

Building is one pass over the query column, trigrams made distinct per text
and bits combined per file in each task; the index of a day is replaced with
the day. Searching reads the index rows of the range; file names reach the
driver, which holds the listing of these files anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail.functions import predicates as P
from qtrail.schemas import EVENT_PARTITIONS, EVENTS
from qtrail.sources import folders as FS
from qtrail.sources.events import read_events

BITS_LOG2 = 20
BLOCK = 32_768
GRAM = 3
INDEX = "_trigrams"  # under the events root, passed over by its readers
_S = T.StringType()
INDEX_SCHEMA = T.StructType([T.StructField("file", _S), T.StructField("block", T.IntegerType()),
                             T.StructField("bits", T.BinaryType()), *[T.StructField(c, _S) for c in EVENT_PARTITIONS]])


def index_root(events_root: str) -> str:
    return f"{events_root.rstrip('/')}/{INDEX}"


def trigram_positions(text: Column) -> Column:
    """Distinct hashed positions of the trigrams of a (lower-cased) text. The
    look-ahead makes one pass over the text."""
    grams = F.regexp_extract_all(text, F.lit("(?s)(?=(" + "." * GRAM + "))"), F.lit(1))
    return F.array_distinct(F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(1 << BITS_LOG2))))


def file_trigrams(events: DataFrame) -> DataFrame:
    """Index rows of the files that ``events`` (read from files) stems from."""
    each = events.select(F.col("_metadata.file_name").alias("file"), *EVENT_PARTITIONS,
                         F.explode_outer(trigram_positions(F.lower("query"))).alias("at"))
    at = F.coalesce("at", F.lit(0))  # a file without any trigram is known too
    return (each.select("file", *EVENT_PARTITIONS, F.floor(at / BLOCK).cast("int").alias("block"), (at % BLOCK).alias("bit"))
            .groupBy("file", *EVENT_PARTITIONS, "block").agg(F.bitmap_construct_agg("bit").alias("bits")))


def write_index(spark: SparkSession, events_root: str, days=None) -> None:
    """Index the events of ``days`` (all without), replacing the index of the
    (region, day) there are."""
    rows = file_trigrams(read_events(spark, events_root, days))
    (rows.select(*[f.name for f in INDEX_SCHEMA.fields]).hint("rebalance", *EVENT_PARTITIONS)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*EVENT_PARTITIONS).parquet(index_root(events_root)))


def _bit_is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1


def unmatched_files(index: DataFrame, text: str) -> DataFrame:
    """``region, day, file`` of the indexed files that lack a trigram of
    ``text`` (one job gives files of several partitions the same name)."""
    spark = index.sparkSession
    wanted = (spark.range(1).select(F.explode(trigram_positions(F.lit(text))).alias("at"))
              .select(F.floor(F.col("at") / BLOCK).cast("int").alias("block"), (F.col("at") % BLOCK).alias("bit")))
    needed = wanted.count()  # at most as many as the text has characters
    found = (index.join(F.broadcast(wanted), "block", "left")
             .groupBy(*EVENT_PARTITIONS, "file").agg(F.count(F.when(_bit_is_set(F.col("bits"), F.col("bit")), 1)).alias("n")))
    return found.where(F.col("n") < needed).select(*EVENT_PARTITIONS, "file")


def matching_files(spark: SparkSession, events_root: str, text: str, days=None, regions=None) -> list[str]:
    """Paths of the files of the range that can hold ``text``."""
    files = read_events(spark, events_root, days, regions).inputFiles()
    text = text.strip().lower()
    root = index_root(events_root)
    if len(text) < GRAM or not FS.exists(spark, root):
        return sorted(files)
    rows = P.all_of(P.in_days(days), P.in_regions(regions))
    index = spark.read.schema(INDEX_SCHEMA).parquet(root).where(rows)
    out = {tuple(r) for r in unmatched_files(index, text).toLocalIterator()}
    return sorted(f for f in files if (*FS.partition_values(f, EVENT_PARTITIONS), f.rsplit("/", 1)[1]) not in out)


def events_containing(spark: SparkSession, events_root: str, text: str, days=None, regions=None) -> DataFrame:
    """The events of the range whose text contains ``text``, whatever the case."""
    from urllib.parse import unquote
    files = [unquote(f) for f in matching_files(spark, events_root, text, days, regions)]
    if not files:
        return spark.createDataFrame([], EVENTS)
    rows = spark.read.schema(EVENTS).option("basePath", events_root).parquet(*files)
    return rows.where(P.all_of(P.in_days(days), P.in_regions(regions), P.contains_text(text)))
