"""The tier map ``(db, tbl) -> tier`` from a landed tag-search dump.

Each table's first value of the tier tag is used; tables without a value are
skipped; when a table appears more than once the last listing wins (dump
order = file, then line, then position in ``TableList``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qtrail.schemas import TAG_SEARCH, TIER_TAG_KEY, TIERS


def tiers_from_tag_dump(spark: SparkSession, path: str) -> DataFrame:
    pages = spark.read.schema(TAG_SEARCH).json(path).select(
        F.col("_metadata.file_path").alias("_f"), F.monotonically_increasing_id().alias("_line"), "TableList")
    items = pages.select("_f", "_line", F.posexplode("TableList").alias("_pos", "t"))
    tagged = items.select(
        "_f", "_line", "_pos",
        F.col("t.Table.DatabaseName").alias("db"), F.col("t.Table.Name").alias("tbl"),
        # Later tag entries overwrite earlier ones; entries without values are ignored.
        F.try_element_at(F.filter("t.LFTagsOnTable",
                                  lambda g: (g["TagKey"] == TIER_TAG_KEY) & (F.size(g["TagValues"]) > 0)),
                         F.lit(-1))["TagValues"].alias("vals"))
    tiered = tagged.select("_f", "_line", "_pos", "db", "tbl",
                           F.try_element_at("vals", F.lit(1)).alias("tier")).where(F.col("tier").isNotNull())
    w = Window.partitionBy("db", "tbl").orderBy(F.desc("_f"), F.desc("_line"), F.desc("_pos"))
    return tiered.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("db", "tbl", "tier")


def tiers_from_table(spark: SparkSession, path: str) -> DataFrame:
    """A tier map kept as a plain (db, tbl, tier) table: Parquet, CSV with a
    header, or JSON lines, chosen by the path's extension."""
    fmt = "csv" if path.rstrip("/").endswith(".csv") else "json" if path.rstrip("/").endswith(
        (".json", ".jsonl")) else "parquet"
    r = spark.read.schema(TIERS)
    df = r.option("header", True).csv(path) if fmt == "csv" else r.json(path) if fmt == "json" else r.parquet(path)
    return df.select("db", "tbl", "tier")


def tiers_from_rows(spark: SparkSession, rows) -> DataFrame:
    """A small literal tier map as a local relation (planned as
    ``LocalTableScan``: no RDD, no Python worker). Values are bound as
    parameters, never spliced into the SQL text."""
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], TIERS)
    args, tuples = {}, []
    for i, (db, tbl, tier) in enumerate(rows):
        args.update({f"d{i}": db, f"t{i}": tbl, f"r{i}": tier})
        tuples.append(f"(CAST(:d{i} AS STRING), CAST(:t{i} AS STRING), CAST(:r{i} AS STRING))")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(tuples)} AS t(db, tbl, tier)", args=args)


def derived_tag_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tag-search dump made from the driver's ``part`` table, one page per
    part: a tagged table, listed a second time with another tier for every
    seventh part; the values of every fifth are empty."""
    key = F.col("p_partkey")

    def listed(values, owner):
        tag = lambda k, v: F.struct(F.lit(k).alias("TagKey"), v.alias("TagValues"))
        return F.struct(F.struct(F.col("p_brand").alias("DatabaseName"), F.concat(F.lit("p"), key.cast("string")).alias("Name")).alias("Table"),
                        F.array(tag("owner", F.array(F.lit(owner))), tag(TIER_TAG_KEY, values)).alias("LFTagsOnTable"))

    tier = F.concat(F.lit("tier_"), (key % 12).cast("string"))
    first = listed(F.when(key % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(tier, F.lit("tier_x"))), "a")
    again = listed(F.array(F.lit("tier_0")), "b")
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.when(key % 7 == 0, F.array(first, again)).otherwise(F.array(first)).alias("TableList"))
