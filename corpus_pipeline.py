"""The corpus pipeline: four stages, each one operator of ``qtrail.llm``.

1. quality: ordinal regression on graded ratings; documents whose tail
   probability P(grade >= 1) is under one half go;
2. toxicity: positive-unlabelled classifier; documents that score one half or
   more go;
3. near duplicates: n-gram Jaccard join; of each group of linked documents the
   one with the smallest id stays (of equal ids, one by the hash of its text);
4. packing: what is left, as pieces of fixed-length sequences with their ids.

Each stage works on all that its predecessor kept, learns from that and from
the labels, and returns the columns of ``documents`` (the last: pieces).
Defined results: null texts count as empty and pass like any other text;
repeated rows and texts end as one document in stage 3; unrelated texts under
one id are documents of their own; documents without an id stand behind those
with one; extra columns pass through, whatever their
names; an empty table gives empty results.

``ORACLE_SQL`` is None: learned models and tokenizers have no SQL form; the
tests hold the result against a plain version in Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrail.llm import ngram_join, packing, quality_ordinal, toxicity_pu
from qtrail.llm.common import materialize, ship_package
from qtrail.llm.queries import KEEP_FROM, quality_ratings, table

ORACLE_SQL = None
TOXIC_FROM = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ratings = quality_ratings(spark, sf_dir).where(toxicity_pu.fold() != 0)
    model = quality_ordinal.train(docs, ratings)
    graded = quality_ordinal.grade_documents(docs, model)
    return graded.where(F.col("tail_probability") >= KEEP_FROM).select("row.*")


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_pu.train(docs, table(spark, sf_dir, "labels"))
    return toxicity_pu.score_documents(docs, model).where(F.col("score") < TOXIC_FROM).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    # Documents without an id get one from their text, above all real ids. The
    # text's hash tells rows of one id apart.
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    above = F.shiftrightunsigned(mark, 3) + F.lit(1 << 62)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.struct(F.coalesce(F.col("doc_id").cast("long"), above).alias("id"), mark.alias("mark")).alias("key"),
                       "text")
    grouped = materialize(ngram_join.linked_components(rows, key="key"), "grouped")
    kept = grouped.where("key = component_id").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    left = rows.join(kept.select("key"), "key", "left_semi")
    if not kept.where("n > 1").isEmpty():  # rows of one id and one text
        left = left.dropDuplicates(["key"])
    return left.select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("toxicity", keep_clean),
    ("n-gram Jaccard join", keep_one_of_each),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
