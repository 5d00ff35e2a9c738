"""Document fingerprints by spot signatures, with DataFrame functions only.

Method. Anchors are the commonest words of the corpus (``anchor_words`` of the
largest document frequencies, counted over all documents). Wherever content
words follow an anchor, the chain of the next ``CHAIN`` content words (anchors
in between are skipped) is a signature; a text's fingerprint is its set of
signatures, written as their sorted hashes. Two fingerprints are compared by
Jaccard likeness. Candidate pairs of a threshold search stem from length
partitions: sets whose sizes differ too much never meet, and within reach only
the rarest signatures of a set (those that a partner must share one of) are
matched.

Scale. Fingerprinting is a map; counting words is pre-aggregated; equal
fingerprints are merged to one representative before the search, so groups of
copies cost one row. The anchors are ``anchor_words`` strings, the only thing
collected.

Defined results: a null text is empty; a text with fewer than ``LEAST_SPOTS``
spots takes the chains at all of its content words, and one without a chain
the hash of its words as its only signature, so equal texts have equal
fingerprints and likeness 1, and an empty text is like empty texts only;
repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qtrail.llm.common import materialize

ANCHOR_WORDS = 192
LEAST_SPOTS = 8
CHAIN = 2
MARK = "\u0001"  # in front of a content word that follows an anchor; never part of a word


def words(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def anchors(docs: DataFrame, text: str = "text", count: int = ANCHOR_WORDS) -> list[str]:
    """The ``count`` words that most documents hold, ties by the word."""
    one = docs.select(F.explode(F.array_distinct(words(F.coalesce(F.col(text), F.lit(""))))).alias("w"))
    top = (one.groupBy("w").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(count))
    return [r["w"] for r in top.collect()]


def content_words(w: Column, anchor: list[str]) -> Column:
    """Those of the words ``w`` that are no anchors, in order; one that stands
    behind an anchor begins with ``MARK``."""
    is_anchor = (lambda x: x.isin(anchor)) if anchor else (lambda x: F.lit(False))
    # Each word beside the one in front of it.
    pairs = F.zip_with(w, F.concat(F.array(F.lit("")), w), lambda x, before: F.when(
        x.isNull() | is_anchor(x), F.lit(None)).when(is_anchor(before), F.concat(F.lit(MARK), x)).otherwise(x))
    return F.array_compact(pairs)


def chains(content: Column, spots_only: bool, chain: int = CHAIN) -> Column:
    """Sorted distinct hashes of the chains that begin at marked words, or at
    any content word."""
    word = lambda i: F.translate(F.get(content, i), MARK, "")
    begins = lambda x: x.startswith(MARK) if spots_only else F.lit(True)
    found = F.transform(content, lambda x, i: F.when(
        begins(x) & (i + (chain - 1) < F.size(content)), F.xxhash64(*[word(i + j) for j in range(chain)])))
    return F.array_sort(F.array_distinct(F.array_compact(found)))


def with_signatures(df: DataFrame, texts: dict[str, str], anchor: list[str], chain: int = CHAIN) -> DataFrame:
    """``df`` and, for each ``name: text column``, an array of signatures."""
    out = df
    for name, text in texts.items():
        out = out.withColumn("_words", words(F.col(text)))
        out = out.withColumn("_content", content_words(F.col("_words"), anchor))
        out = out.withColumn("_found", chains(F.col("_content"), True, chain))
        out = out.withColumn("_found", F.when(F.size("_found") >= LEAST_SPOTS, F.col("_found"))
                             .otherwise(chains(F.col("_content"), False, chain)))
        whole = F.array(F.xxhash64(F.concat_ws(" ", "_words")))
        out = out.withColumn(name, F.when(F.size("_found") > 0, F.col("_found")).otherwise(whole))
        out = out.drop("_words", "_content", "_found")
    return out


def written(signatures: Column) -> Column:
    """A fingerprint as text: the hashes in hexadecimal, joined by dots."""
    return F.array_join(F.transform(signatures, lambda x: F.lower(F.hex(x))), ".")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature arrays (distinct, never empty)."""
    shared = F.size(F.array_intersect(a, b))
    return (shared / (F.size(a) + F.size(b) - shared)).cast("double")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 anchor: list[str] | None = None) -> DataFrame:
    """``key``, ``signatures`` and ``fingerprint`` of every document."""
    anchor = anchors(docs, text) if anchor is None else anchor
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return (with_signatures(rows, {"signatures": "_text"}, anchor).drop("_text")
            .withColumn("fingerprint", written(F.col("signatures"))))


# -- search ------------------------------------------------------------------
def near_pairs(prints: DataFrame, threshold: float = 0.8, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b, likeness`` of class representatives whose likeness
    reaches ``threshold``, and the membership ``key, representative`` of
    documents with equal fingerprints."""
    prints = materialize(prints.select(key, "signatures"), "fingerprints")
    classes = prints.groupBy("signatures").agg(F.min(key).alias("representative"))
    members = prints.join(classes, "signatures").select(key, "representative")
    size = F.size("signatures")
    reps = classes.select("representative", "signatures", size.alias("n"),
                          F.floor(F.log(size.cast("double")) / F.log(F.lit(1 / threshold))).cast("int").alias("part"))
    each = reps.select("representative", "n", "part", F.explode("signatures").alias("s"))
    counts = each.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # A set shares one of its rarest n - ceil(t n) + 1 signatures with every
    # partner, in one order for all; those of a single set match nothing.
    rarest = Window.partitionBy("representative").orderBy("df", "s")
    ranked = (each.join(counts, "s", "left").withColumn("df", F.coalesce("df", F.lit(1)))
              .withColumn("k", F.row_number().over(rarest))
              .where((F.col("k") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1) & (F.col("df") > 1)))
    a = ranked.select(F.col("representative").alias("a"), F.col("n").alias("na"), "s", "part")
    b = ranked.select(F.col("representative").alias("b"), F.col("n").alias("nb"), "s",
                      F.explode(F.array(F.col("part"), F.col("part") - 1, F.col("part") + 1)).alias("part"))
    close = (F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.greatest("na", "nb") * threshold - 1e-9)
    candidates = a.join(b, ["s", "part"]).where(close).select("a", "b").distinct()
    left = reps.select(F.col("representative").alias("a"), F.col("signatures").alias("sa"))
    right = reps.select(F.col("representative").alias("b"), F.col("signatures").alias("sb"))
    pairs = (candidates.join(left, "a").join(right, "b")
             .select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness"))
             .where(F.col("likeness") >= threshold - 1e-12))
    return pairs, members


# -- texts beside the next document's ----------------------------------------
def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", anchor: list[str] | None = None,
              per_bucket: int = 2048) -> DataFrame:
    """``key``, ``text``, ``signatures`` of every document and those of the
    next one in ascending order of key (then text; after the last the first)
    as ``next_text`` and ``next_signatures``. Keys are dealt by ranges into
    buckets of about ``per_bucket`` rows, and the first row of a bucket visits
    the bucket before as well: one shuffle of the texts, and no global sort."""
    anchor = anchors(docs, text) if anchor is None else anchor
    rows = docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n, low, high = rows.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    low, high = (0, 0) if low is None else (low, high)
    width = max(1, -(-(high - low + 1) // max(64, -(-n // per_bucket))))
    bucket = F.coalesce(F.floor((F.col(key) - F.lit(low)) / F.lit(width)).cast("long"), F.lit(-1).cast("long"))
    rows = rows.withColumn("bucket", bucket)
    # One narrow row per bucket: where its first row visits.
    order = Window.orderBy("bucket")
    firsts = rows.groupBy("bucket").agg(F.min(key).alias("first"))
    last = firsts.agg(F.max("bucket").alias("last_bucket"))
    visits = (firsts.withColumn("before", F.lag("bucket").over(order)).join(F.broadcast(last), F.lit(True), "left")
              .select(F.col("first"), F.coalesce("before", "last_bucket").alias("visited")))
    guests = (rows.join(visits, rows[key].eqNullSafe(visits["first"]))
              .select(key, "text", F.col("visited").alias("bucket"), F.lit(1).alias("guest")))
    dealt = (rows.withColumn("guest", F.lit(0)).unionByName(guests).repartition("bucket"))
    signed = with_signatures(dealt, {"signatures": "text"}, anchor)
    following = Window.partitionBy("bucket").orderBy("guest", key, "text")
    return (signed.withColumns({"next_text": F.lead("text").over(following),
                                "next_signatures": F.lead("signatures").over(following)})
            .where("guest = 0").drop("guest", "bucket"))


def edited(docs_with_next: DataFrame) -> DataFrame:
    """``edited_text``: the last quarter of the code points replaced by as
    many of the next text's first."""
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    return docs_with_next.withColumns({
        "n_chars": n.cast("long"),
        "edited_text": F.concat(F.substring(F.col("text"), F.lit(1), n - cut),
                                F.substring(F.col("next_text"), F.lit(1), cut))})
