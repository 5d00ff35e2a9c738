"""Source divergence audit: how far the word use of each source lies from that
of every other source of its language, and which terms set it apart.

Method. One-hot level products. Within a language, a term has a count in every
group (source); the count is the term's level there. Indicator columns, one
for each (group, level), over rows of terms form a 0/1 matrix X. A block of the
product X^T X holds, for each pair of its groups, the joint table of their
levels: how many terms stand at level a here and at level b there. A joint
table is all that a sum over terms of a function of both counts needs, so
each table cell is priced once, whatever its number of terms. Level 0 has no
column: most terms lack in most groups, and its part of every table follows
from the others by inclusion and exclusion. All arithmetic is in integers.

Scale. Counting is one map over the texts, combined in the task, and one
shuffle on (language, term). The product is cut in blocks of terms (by hash,
as many as the counts' rows ask for) by pairs of blocks of groups (by hash, of
about ``GROUPS``); a task sees one block, multiplies it by sparse outer
products in bounded chunks, and returns one number for each pair of groups.
A source with a third of all rows has one row a term once counted. The driver
holds nothing of the data.

Defined results: null text, language and source are ''; a text without terms
counts as a document of its group; a language without kept terms gives pairs
of value 0 and no terms; repeated rows count as often as they stand there;
equal values are ranked by the item's UTF-8 bytes; other columns are not read;
an empty table gives empty results. Counts must stay under 9 * 10**15 a
language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qtrail.llm.common import materialize, slices, text_column

LEAST_DOCS = 10
TOP_TERMS = 10
GROUPS = 64  # groups of one side of a block, about
ROWS = 400_000  # counted rows of a block of terms, about
PAIRS = 1 << 21  # entries of a product expanded at once
HELD = 400_000  # counted terms that a task holds before it hands them on
SEGMENT = 1 << 20  # bytes of a text split at once
SCALE = 1_000_000_000

# Everything but ASCII letters and bytes from 0x80 separates; A-Z become a-z.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def segments_of_terms(text: bytes) -> Iterator[list[bytes]]:
    """Lists of the terms of a whole text, in order, from parts that end
    between terms."""
    plain = text.translate(_TERM)
    at = 0
    while at < len(plain):
        stop = len(plain)
        if stop - at > SEGMENT:
            gap = plain.find(b" ", at + SEGMENT)
            stop = gap if gap >= 0 else stop
        yield plain[at:stop].split()
        at = stop


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of a table ``lang, source, text``,
    combined within each task: occurrences, and documents with the term."""
    schema = "lang string, source string, term string, n long, docs long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], Counter] = {}
        within: dict[tuple[str, str], Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), n in found.items():
                terms, docs_of = list(n), within[lang, source]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                     pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                     pa.array([docs_of[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "docs"])
            found.clear()
            within.clear()

        for b in slices(batches):
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_column(b)):
                group = (lang, source)
                if group not in found:
                    found[group], within[group] = Counter(), Counter()
                seen: set[bytes] = set()
                for terms in segments_of_terms(text):
                    found[group].update(terms)
                    fresh = set(terms) - seen if seen else set(terms)
                    within[group].update(fresh)
                    seen |= fresh
            if sum(map(len, found.values())) > HELD:
                yield from flush()
        yield from flush()

    return docs.mapInArrow(run, schema)


def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, term, n, lang_n, first`` of the terms that at least
    ``least_docs`` documents of their language hold: one row for each group
    with the term; ``first`` marks one row a term."""
    whole = Window.partitionBy("lang", "term")
    # Dealt by (lang, term) once: the sums by group and over groups both follow.
    counts = (term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return (counts.withColumns({"lang_n": F.sum("n").over(whole), "lang_docs": F.sum("docs").over(whole),
                                "first": F.row_number().over(whole.orderBy("source")) == 1})
            .where(F.col("lang_docs") >= least_docs).drop("docs", "lang_docs"))


def group_sizes(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """One row for each group of ``docs``: ``lang, source``, the denominators
    ``group_d`` and ``lang_d``, the number of kept terms ``v``, and how many
    blocks its language has: ``term_blocks``, ``group_blocks``."""
    def blocks(rows: str, each: int) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.coalesce(F.col(rows), F.lit(0)) / each)).cast("int")

    groups = docs.select("lang", "source").distinct()
    langs = (groups.groupBy("lang").agg(F.count(F.lit(1)).alias("groups"))
             .join(counts.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum(F.col("first").cast("long")).alias("v"),
                                              F.count(F.lit(1)).alias("rows")), "lang", "left"))
    v = F.coalesce("v", F.lit(0))
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    return groups.join(own, ["lang", "source"], "left").join(langs, "lang").select(
        "lang", "source", (F.coalesce("n", F.lit(0)) + 2 * v).alias("group_d"),
        (F.coalesce("lang_n", F.lit(0)) + 2 * v).alias("lang_d"), v.alias("v"),
        blocks("rows", ROWS).alias("term_blocks"), blocks("groups", GROUPS).alias("group_blocks"))


# -- products ----------------------------------------------------------------
def shares(counts: np.ndarray, denominators: np.ndarray) -> np.ndarray:
    """``1 + SCALE * (count + 2) // denominator`` by long division in base
    1000, so that no step leaves 64 bits."""
    whole, rest = np.divmod(counts + 2, denominators)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, denominators)
        whole = whole * 1000 + digit
    return whole + 1


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def products(term_a: np.ndarray, col_a: np.ndarray, term_b: np.ndarray, col_b: np.ndarray,
             width_b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Cells ``(column of A, column of B, terms)`` of A^T B for 0/1 matrices
    given by the places of their ones: the sum over rows of the outer products
    of a row of A with the same row of B, over chunks of rows."""
    order_a, order_b = np.argsort(term_a, kind="stable"), np.argsort(term_b, kind="stable")
    term_a, col_a, col_b = term_a[order_a], col_a[order_a], col_b[order_b]
    sorted_b = term_b[order_b]
    low = np.searchsorted(sorted_b, term_a, "left")
    many = np.searchsorted(sorted_b, term_a, "right") - low
    ends = np.cumsum(many)
    at = 0
    while at < term_a.size:
        done = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        n = many[at:stop]
        if total := int(n.sum()):
            inside = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
            key = np.repeat(col_a[at:stop], n) * width_b + col_b[np.repeat(low[at:stop], n) + inside]
            cells, terms = np.unique(key, return_counts=True)
            yield cells // width_b, cells % width_b, terms
        at = stop


def block_values(terms: np.ndarray, groups: np.ndarray, n: np.ndarray, denominators: np.ndarray,
                 side_a: np.ndarray, side_b: np.ndarray) -> np.ndarray:
    """Sums of prices over the terms of a block that one of two groups holds,
    less what level 0 costs on both sides, for each pair of a group of
    ``side_a`` and one of ``side_b``. Rows: ``terms``, index of the group,
    count; ``denominators`` by group."""
    out = np.zeros((side_a.size, side_b.size), np.int64)
    none = shares(np.zeros_like(denominators), denominators)

    def columns(side: np.ndarray):
        place = np.full(denominators.size, -1)
        place[side] = np.arange(side.size)
        mine = place[groups] >= 0
        width = int(n.max()) + 1
        level, col = np.unique(place[groups[mine]] * width + n[mine], return_inverse=True)
        at, count = level // width, level % width
        return terms[mine], col, at, shares(count, denominators[side[at]]), np.bincount(col, minlength=level.size)

    term_a, col_a, at_a, p, often_a = columns(side_a)
    term_b, col_b, at_b, q, often_b = columns(side_b)
    none_a, none_b = none[side_a], none[side_b]
    both_none = prices(none_a[:, None], none_b[None, :])
    # Each level of one side against level 0 of every group of the other.
    step = max(1, PAIRS // max(1, side_a.size, side_b.size))
    for lo in range(0, at_a.size, step):
        at = at_a[lo:lo + step]
        priced = prices(p[lo:lo + step, None], none_b) - both_none[at]
        np.add.at(out, at, often_a[lo:lo + step, None] * priced)
    for lo in range(0, at_b.size, step):
        at = at_b[lo:lo + step]
        priced = prices(none_a, q[lo:lo + step, None]) - both_none.T[at]
        np.add.at(out.T, at, often_b[lo:lo + step, None] * priced)
    for i, j, often in products(term_a, col_a, term_b, col_b, max(1, q.size)):
        a, b = at_a[i], at_b[j]
        priced = prices(p[i], q[j]) - prices(p[i], none_b[b]) - prices(none_a[a], q[j]) + both_none[a, b]
        np.add.at(out, (a, b), often * priced)
    return out


def pair_values(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each two sources of a language."""
    key = ["lang", "block", "a", "b"]
    block = F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int")

    def dealt(rows: DataFrame) -> DataFrame:
        """Copies of a row for each pair of blocks of groups with its own."""
        other = F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1))
        return (rows.withColumn("own", block).withColumn("other", other)
                .withColumns({"a": F.least("own", "other"), "b": F.greatest("own", "other")}))

    left = dealt(counts.join(sizes, ["lang", "source"])).select(
        *[F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("block") if c == "block" else c for c in key],
        "term", "source", "n")
    right = dealt(sizes.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)))).select(
        *key, "source", "own", "group_d", "v")

    def multiply(held: pa.Table, groups: pa.Table) -> pa.Table:
        lang, at, a, b = (groups.column(c)[0].as_py() for c in key)
        names = groups.column("source").to_pylist()
        own = groups.column("own").to_numpy()
        d = groups.column("group_d").to_numpy().astype(np.int64)
        v = groups.column("v")[0].as_py()
        side_a, side_b = np.flatnonzero(own == a), np.flatnonzero(own == b)
        value = np.zeros((side_a.size, side_b.size), np.int64)
        if v:
            if held.num_rows:
                code = held.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
                place = {s: i for i, s in enumerate(names)}
                group = np.array([place[s] for s in held.column("source").to_pylist()])
                value += block_values(code.astype(np.int64), group, held.column("n").to_numpy().astype(np.int64), d,
                                      side_a, side_b)
            if at == 0:  # once for all blocks of terms: every term at level 0 on both sides
                none = shares(np.zeros_like(d), d)
                value += v * prices(none[side_a][:, None], none[side_b][None, :])
        i, j = (x.ravel() for x in np.meshgrid(side_a, side_b, indexing="ij"))
        flat = value.ravel()
        if a != b:
            i, j, flat = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([flat, flat])
        differ = i != j
        named = pa.array(names, pa.string())
        return pa.table({"lang": pa.array([lang] * int(differ.sum()), pa.string()), "source": named.take(pa.array(i[differ])),
                         "item": named.take(pa.array(j[differ])), "value": pa.array(flat[differ], pa.int64())})

    parts = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        multiply, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of the terms that stand out in a group."""
    share = f"1 + (CAST({SCALE} AS DECIMAL(38, 0)) * ({{n}} + 2)) div {{d}}"
    rows = (counts.join(sizes, ["lang", "source"])
            .withColumns({"p": F.expr(share.format(n="n", d="group_d")), "q": F.expr(share.format(n="lang_n", d="lang_d"))}))
    return rows.where("p > q").select("lang", "source", F.col("term").alias("item"),
                                      F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))


def ranked(values: DataFrame, top: int | None = None) -> DataFrame:
    """``rank`` from 1 within each group, the largest value first."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    out = values.withColumn("rank", F.row_number().over(order))
    return out if top is None else out.where(F.col("rank") <= top)


def divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
               least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> tuple[DataFrame, DataFrame]:
    """``lang, source, item, value, rank``: other sources by distance (all),
    and terms that stand out (the first ``top`` of each group)."""
    def named(column: str, as_name: str) -> Column:
        return F.coalesce(F.col(f"`{column}`"), F.lit("")).alias(as_name)

    rows = docs.select(named(lang, "lang"), named(source, "source"), named(text, "text"))
    counts = materialize(kept_counts(rows, least_docs), "term-counts")
    sizes = materialize(group_sizes(rows, counts), "group-sizes")
    return ranked(pair_values(counts, sizes)), ranked(term_values(counts, sizes), top)
