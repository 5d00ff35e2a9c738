"""N-gram Jaccard self-join by a count-vector R-tree.

Method. A document's shingles are hashed into groups and its group counts are
a point; two documents share at most the sum of coordinate minima of their
points (``count_rtree``), which prunes whole nodes and then pairs; pairs that
survive are verified on the shingle sets. Everything is exact.

An R-tree over hashed counts tells near from far documents, but its upper
nodes cover everything, so one tree over the whole corpus would compare all
with all. The trees therefore stand in cells: sets are ordered shingle by
shingle (rarest first, by a count sketch over all documents, ties by hash),
and a set of n shingles enters the cells of its first n - ceil(0.8 n) + 1.
Two sets that reach 0.8 share one of these, so each link lies in a cell.

Steps.
1. One pass: each document's set size and set digest, and the sketch (fixed
   width) of shingle frequencies. Equal sets are one class from here on.
2. One pass: cell rows (shingle, digest, size). Cells of one class are dropped.
3. One pass: count vectors of the classes that are left, one document of each,
   chosen by a bitmap of fixed width. (Sets are derived in the same way, only
   for classes in pairs that the bound lets pass.)
4. Links are found in three rounds, each over what the rounds before have not
   connected: (a) every class with the first of its cell, (b) classes of
   crowded cells among themselves, in blocks bounded by bytes, a union-find
   saving most tests, (c) in every cell that still holds several components,
   the R-tree search of all members outside the largest one. Round (c) is
   complete for each cell, whatever (a) and (b) found.
5. Components; each document gets the smallest id of its component.

Scale. A group of copies costs one class. In a group of near copies rounds (a)
and (b) connect the bulk with about one test per member, and only outliers are
compared with all others, by count vectors within blocks of bounded size: no
task holds an unbounded group, no cell emits its pairs, none is capped. The
driver collects the sketch and the bitmap only (fixed size).

Defined results: a null or empty text and one of white space have no shingles
and link with nothing; fewer words than ``size`` form one shingle; repeated
rows give repeated results; null ids stand aside when the smallest id is
taken; other columns play no part; an empty table gives an empty result.
Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail.llm.common import U64, batch_word_hashes, materialize, mix, shingle_hashes, slices, text_column
from qtrail.llm.components import components
from qtrail.llm.count_rtree import CountRTree, count_vector, fold, linked, may_link

SIZE = 5
PERCENT = 80
SKETCH_BITS = 22
SKETCH_CHUNKS = 64
BITMAP_BITS = 24
CROWDED = 48  # classes in a cell from which round (b) looks at it
BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 2048


def digest(shingles: np.ndarray) -> int:
    """Signed 64-bit digest of a set (sorted distinct hashes)."""
    power = mix(np.arange(1, shingles.size + 1, dtype=np.uint64))
    return int(mix((mix(shingles) * (power | U64(1))).sum(dtype=np.uint64, keepdims=True) + U64(shingles.size))
               .view(np.int64)[0])


def documents_shingles(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for row, words in batch_word_hashes(text_column(batch, "_text")):
        yield row, shingle_hashes(words, size)


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1


# -- passes over the documents ----------------------------------------------
def _statistics(docs: DataFrame, size: int) -> DataFrame:
    """Per document ``key, n, d``; per task chunks of its sketch."""
    schema = T.StructType([T.StructField("key", docs.schema["key"].dataType), T.StructField("n", T.LongType()),
                           T.StructField("d", T.LongType()), T.StructField("_key", T.LongType()),
                           T.StructField("chunk", T.IntegerType()), T.StructField("counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, kind = np.zeros(1 << SKETCH_BITS, np.uint32), None
        for b in slices(batches):
            kind = b.column(0).type
            n, d, held, waiting = [], [], [], 0
            for _, s in documents_shingles(b, size):
                n.append(s.size)
                d.append(digest(s) if s.size else None)
                held.append(s)
                waiting += s.size
                if waiting > 1 << 20:
                    np.add.at(sketch, (np.concatenate(held) >> U64(64 - SKETCH_BITS)).astype(np.int64), 1)
                    held, waiting = [], 0
            if held:
                np.add.at(sketch, (np.concatenate(held) >> U64(64 - SKETCH_BITS)).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(d, pa.int64()), b.column("_key"),
                 pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names=schema.names)
        if kind is not None:
            parts = sketch.reshape(SKETCH_CHUNKS, -1)
            kept = [i for i in range(SKETCH_CHUNKS) if parts[i].any()]
            k = len(kept)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, kind), *(pa.nulls(k, pa.int64()) for _ in range(3)), pa.array(kept, pa.int32()),
                 pa.array([zlib.compress(parts[i].tobytes(), 1) for i in kept], pa.binary())], names=schema.names)

    return materialize(docs.mapInArrow(run, schema), "statistics")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for chunk, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            counts = np.frombuffer(zlib.decompress(raw), np.uint32).astype(np.uint64)
            total[chunk] = total[chunk] + counts if chunk in total else counts
    for chunk, counts in total.items():
        raw = np.minimum(counts, 65_535).astype("<u2").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([raw], pa.binary())],
                                         names=["chunk", "counts"])


def _sketch(statistics: DataFrame) -> np.ndarray:
    """Summed sketch: 2 ** SKETCH_BITS counters of 16 bits."""
    rows = (statistics.where("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk")
            .mapInArrow(_summed, "chunk int, counts binary").collect())
    out = np.zeros((SKETCH_CHUNKS, (1 << SKETCH_BITS) // SKETCH_CHUNKS), np.uint16)
    for r in rows:
        out[r["chunk"]] = np.frombuffer(r["counts"], "<u2")
    return out.ravel()


def _cells(docs: DataFrame, sketch: np.ndarray, size: int, percent: int) -> DataFrame:
    """``h, d, n``: the cells of every class, at least once."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, set()
        for b in slices(batches):
            h, d, n = [], [], []
            for _, s in documents_shingles(b, size):
                if not s.size or (key := digest(s)) in seen:
                    continue
                seen.add(key)
                k = prefix_length(s.size, percent)
                weight = counts[(s >> U64(64 - SKETCH_BITS)).astype(np.int64)]
                h.append(s[np.lexsort((s, weight))[:k]])
                d.append(np.full(k, key, np.int64))
                n.append(np.full(k, s.size, np.int32))
            if h:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(h).view(np.int64)), pa.array(np.concatenate(d)),
                     pa.array(np.concatenate(n))], names=["h", "d", "n"])

    cell = Window.partitionBy("h")
    rows = docs.mapInArrow(run, "h long, d long, n int").repartition("h")
    crowd = rows.withColumns({"_lo": F.min("d").over(cell), "_hi": F.max("d").over(cell)}).where("_lo < _hi")
    return materialize(crowd.select("h", "d", "n").distinct(), "cells")


def _place(d: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Bits of documents, by digest and hashed key."""
    return (mix(d.view(np.uint64) ^ mix(key.view(np.uint64))) >> U64(64 - BITMAP_BITS)).astype(np.int64)


def _bitmap(rows: DataFrame) -> np.ndarray:
    """Bits of ``d, _key``: fixed size, false hits harmless."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << BITMAP_BITS, bool)
        for b in batches:
            out[_place(b.column(0).to_numpy(), b.column(1).to_numpy())] = True
        raw = zlib.compress(np.packbits(out).tobytes(), 1)
        yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["bits"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
        for b in batches:
            for raw in b.column(0).to_pylist():
                out |= np.frombuffer(zlib.decompress(raw), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(out.tobytes(), 1)], pa.binary())], names=["bits"])

    got = rows.mapInArrow(bits, "bits binary").repartition(1).mapInArrow(joined, "bits binary").collect()
    out = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for r in got:
        out |= np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return out


def _derived(docs: DataFrame, statistics: DataFrame, wanted: DataFrame, size: int, name: str,
             derive: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``d`` and a binary column ``name`` for the classes of ``wanted`` (column
    ``d``), from one document of each: that of the smallest hashed key. (A
    false hit of the bitmap may repeat a row; pairs are distinct again in the
    end.)"""
    one = statistics.where("d IS NOT NULL").groupBy("d").agg(F.min("_key").alias("_key"))
    shared = docs.sparkSession.sparkContext.broadcast(
        _bitmap(one.join(wanted.select("d").distinct(), "d", "left_semi").select("d", "_key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for b in slices(batches):
            keys, ids, out = b.column("_key").to_numpy(), [], []
            for row, s in documents_shingles(b, size):
                if not s.size:
                    continue
                key = digest(s)
                bit = int(_place(np.array([key]), keys[row:row + 1])[0])
                if bits[bit >> 3] >> (7 - (bit & 7)) & 1 and key not in seen:
                    seen.add(key)
                    ids.append(key)
                    out.append(derive(s).tobytes())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())],
                                                 names=["d", name])

    return materialize(docs.mapInArrow(run, f"d long, {name} binary"), name)


# -- links -------------------------------------------------------------------
def _pair_filter(columns: tuple[str, str], test: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = (b.column(c).to_pylist() for c in columns)
            keep = pa.array([test(x, y) for x, y in zip(left, right)], pa.bool_())
            yield b.select(["a", "b"]).filter(keep)
    return run


def _bounded(x: bytes, y: bytes, percent: int) -> bool:
    # The counts of a point sum to its size.
    p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    return may_link(p, int(p.sum(dtype=np.int64)), q, int(q.sum(dtype=np.int64)), percent)


def _exact(x: bytes, y: bytes, percent: int) -> bool:
    return linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)


def _passing(pairs: DataFrame, points: DataFrame, column: str, test: Callable, percent: int) -> DataFrame:
    """Pairs (``a, b``) whose values in ``points`` pass the test."""
    a = points.select(F.col("d").alias("a"), F.col(column).alias("x"))
    b = points.select(F.col("d").alias("b"), F.col(column).alias("y"))
    run = _pair_filter(("x", "y"), lambda x, y: test(x, y, percent))
    return materialize(pairs.join(a, "a").join(b, "b").mapInArrow(run, "a long, b long"), f"pairs-{column}")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("d"))


class _Union:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x


def block_links(ids: list[int], vecs: list[bytes], items: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Links that connect a block as all its links would: R-tree candidates,
    most promising first, tested unless already connected."""
    sets = [np.frombuffer(x, np.uint64) for x in items]
    sizes = np.array([s.size for s in sets])
    raw = [np.frombuffer(v, np.uint8) for v in vecs]
    union, out = _Union(len(ids)), []
    for members, counts, own in _levels(raw):
        tree = CountRTree(counts, sizes[members])
        for i in range(len(members)):
            found = tree.search(counts[i], int(sizes[members[i]]), percent)
            found = found[(found < i) & (own[found] | own[i])]
            promise = np.minimum(counts[found], counts[i]).sum(1, dtype=np.int64)
            for j in found[np.argsort(-promise, kind="stable")]:
                x, y = union.find(int(members[i])), union.find(int(members[j]))
                if x != y and linked(sets[members[i]], sets[members[j]], percent):
                    union.parent[x] = y
                    out.append((ids[members[i]], ids[members[j]]))
    return out


def _levels(raw: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each number of groups: the members that have so many, or up to four
    times as many (partners differ by that much at most), their counts folded
    to it, and which members have exactly so many."""
    width = np.array([r.size for r in raw])
    for groups in np.unique(width):
        members = np.flatnonzero((width >= groups) & (width <= 4 * groups))
        if members.size > 1:
            yield members, np.stack([fold(raw[m], int(groups)) for m in members]), width[members] == groups


def cell_pairs(ids: np.ndarray, labels: np.ndarray, vecs: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Pairs of a cell that lie in different components and pass the bound.
    Members of the largest component search nothing: all others do."""
    values, counts = np.unique(labels, return_counts=True)
    if values.size < 2:
        return []
    asks = labels != values[counts.argmax()]
    raw = [np.frombuffer(v, np.uint8) for v in vecs]
    out = set()
    for members, points, own in _levels(raw):
        sizes = points.sum(1, dtype=np.int64)
        tree = CountRTree(points, sizes)
        for i in np.flatnonzero(asks[members]):
            found = tree.search(points[i], int(sizes[i]), percent)
            found, x = members[found[own[found] | own[i]]], members[i]
            for y in found[labels[found] != labels[x]]:
                out.add((min(ids[x], ids[y]), max(ids[x], ids[y])))
    return list(out)


def _streamed_cells(percent: int) -> Callable:
    """Rows sorted by cell, one cell in memory at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def pairs() -> list[tuple[int, int]]:
            if len(rows) < 2:
                return []
            d, c, v = zip(*rows)
            return cell_pairs(np.array(d), np.array(c), list(v), percent)

        for b in batches:
            out = []
            h, s, d, c, v = (b.column(x).to_pylist() for x in ("h", "cell", "d", "c", "vec"))
            for cell, row in zip(zip(h, s), zip(d, c, v)):
                if cell != key:
                    out += pairs()
                    key, rows = cell, []
                rows.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["a", "b"])
        if out := pairs():
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["a", "b"])
    return run


def _labelled(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """Cells that still hold several components, without their first member
    (round (a) has tested all its pairs), with ``c`` and the cell's sizes."""
    cell = Window.partitionBy("h")
    rows = (cells.withColumn("_first", F.min("d").over(cell)).where("d <> _first")
            .join(labels, F.col("d") == labels["v"], "left").select("h", "d", "n", F.coalesce("c", "d").alias("c")))
    return (rows.withColumns({"_lo": F.min("c").over(cell), "_hi": F.max("c").over(cell),
                              "crowd": F.count(F.lit(1)).over(cell), "total": F.sum("n").over(cell)})
            .where("_lo < _hi").drop("_lo", "_hi"))


def _first_of_cell(cells: DataFrame) -> DataFrame:
    """Round (a): each class with its cell's first, where the sizes allow."""
    firsts = cells.groupBy("h").agg(F.min(F.struct("d", "n")).alias("f"))
    rows = cells.join(firsts, "h").where("d <> f.d")
    return rows.select(F.col("f.d").alias("a"), F.col("d").alias("b"), F.col("f.n").alias("na"), "n")


def _crowded(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of round (b): every class in the two most crowded of its cells."""
    rows = _labelled(cells, labels).where(F.col("crowd") >= CROWDED)
    top = Window.partitionBy("d").orderBy(F.desc("crowd"), "h")
    rows = rows.withColumn("_k", F.row_number().over(top)).where("_k <= 2")
    blocks = F.greatest(F.ceil(F.col("total") * 8 / BLOCK_BYTES), F.ceil(F.col("crowd") / BLOCK_ROWS))
    rows = rows.select("h", "d", F.pmod(F.xxhash64("d", "h"), blocks.cast("long")).alias("block"))
    return materialize(rows, "crowded")


def _crowded_links(rows: DataFrame, vecs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        found = block_links(t.column("d").to_pylist(), t.column("vec").to_pylist(), t.column("items").to_pylist(), percent)
        return pa.table([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return (rows.join(vecs, "d").join(sets, "d").groupBy("h", "block").applyInArrow(run, "a long, b long"))


def _remaining_pairs(cells: DataFrame, labels: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Round (c): the R-tree search of every cell with several components; a
    large cell is searched block by block, each block with each."""
    rows = _labelled(cells, labels)
    rows = rows.withColumn("_blocks", F.ceil(F.col("crowd") / BLOCK_ROWS).cast("int"))
    own = F.pmod(F.xxhash64("d"), F.col("_blocks").cast("long")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda k: (
        F.least(own, k) * F.col("_blocks") + F.greatest(own, k)).cast("long"))
    rows = rows.select("h", F.explode(others).alias("cell"), "d", "c")
    dealt = (rows.join(points, "d").repartition("h", "cell")
             .sortWithinPartitions("h", "cell").select("h", "cell", "d", "c", "vec"))
    return materialize(dealt.mapInArrow(_streamed_cells(percent), "a long, b long").distinct(), "pairs-c")


def linked_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
                      percent: int = PERCENT) -> DataFrame:
    """``key, n_shingles, component_id`` of every document."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("_text"),
                       F.xxhash64(F.col(key)).alias("_key"))
    statistics = _statistics(rows, size)
    cells = _cells(rows, _sketch(statistics), size, percent)
    vecs = _derived(rows, statistics, cells, size, "vec", count_vector)
    near = F.least("na", "n") * 100 >= F.greatest("na", "n") * percent
    firsts = _first_of_cell(cells).where(near).select("a", "b").distinct()
    likely = _passing(firsts, vecs, "vec", _bounded, percent)
    links = _passing(likely, _derived(rows, statistics, _ends(likely), size, "items", lambda s: s),
                     "items", _exact, percent)
    labels = components(links)
    crowded = _crowded(cells, labels)
    if not crowded.isEmpty():
        sets = _derived(rows, statistics, crowded, size, "items", lambda s: s)
        links = materialize(links.union(_crowded_links(crowded, vecs, sets, percent)), "links-b")
        labels = components(links)
    likely = _remaining_pairs(cells, labels, vecs, percent)
    rest = _passing(likely, _derived(rows, statistics, _ends(likely), size, "items", lambda s: s),
                    "items", _exact, percent)
    labels = components(links.union(rest))
    own = statistics.where("chunk IS NULL").select("key", "n", "d")
    classed = own.join(labels, own["d"] == labels["v"], "left").select("key", "n", F.coalesce("c", "d").alias("c"))
    smallest = classed.where("n > 0").groupBy("c").agg(F.min("key").alias("first"))
    return (classed.join(smallest.withColumnRenamed("c", "_c"), F.col("c") == F.col("_c"), "left")
            .select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                    F.coalesce("first", "key").alias("component_id")))
