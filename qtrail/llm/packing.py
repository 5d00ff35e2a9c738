"""Packing documents into fixed-length sequences by cutting-stock column
generation.

Method. Every document's ids are cut at multiples of the capacity, so at most
its last piece is short. Pieces fall into length classes (multiples of
``UNIT`` tokens, rounded up), whose counts over all pieces are the demands of
a cutting-stock problem: a linear program over patterns (how many pieces of
each class share a sequence), whose columns an unbounded-knapsack dynamic
program prices with the duals. The solution is rounded down; what is left of
the demands (a few hundred sequences at most, whatever the input) is filled by
a bounded knapsack. Patterns then claim rank ranges of their classes, and each
piece finds its sequence from its rank among the pieces of its class.

Scale. Tokenizing is one map. Pieces are written with their ids once, under
the shared checkpoint folder: ranks refer to rows that no lost executor can
change. Ranking and placing read and shuffle one narrow row per piece, without
ids; ranks are counted in two steps (within an input split, then over splits),
so no class is gathered in one task. One hash join on a number of the piece
brings the places back to the ids, which are shuffled there once and never
sorted. Where the vocabulary allows, ids take two bytes until then. The driver
holds the histogram (``capacity / UNIT`` classes) and the patterns, both
bounded by constants, and broadcasts the rank ranges.

Defined results: a null text is empty and packs as its end id alone; repeated
rows are packed one by one; equal lengths are ranked by key and start; an
empty table gives an empty result. The rows of a sequence are found by
``sequence_id`` and ``offset``; they come in no order.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail.llm.common import by_bytes, local_rows, materialize, slices, tokenizer_file
from qtrail.llm.wordmemo import WordMemo, dropped_space_pieces, load_tokenizer, plain_words, segments, split_flags

CAPACITY = 2048
UNIT = 16
END_ID = 1
BATCH_BYTES = 1 << 20
MAX_PIVOTS = 4000
GAP = 2e-3  # pricing ends when no pattern saves more of a sequence than this


# -- tokens ------------------------------------------------------------------
def little_endian(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordMemo:
    """Little-endian id bytes of pieces, for a lower-casing vocabulary with
    word ends that drops white space. A worker keeps it from task to task, so
    that frequent words are encoded once in a worker and not once in a task."""
    tok = load_tokenizer(path)
    vocab = tok.get_vocab()
    ends = np.zeros(max(vocab.values()) + 1, bool)
    ends[[i for s, i in vocab.items() if s.endswith("</w>")]] = True

    def direct(pieces: list[str]) -> list[bytes]:
        return [little_endian(e.ids) for e in tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def joined(words: list[str]) -> list[bytes] | None:
        [joint] = tok.encode_batch_fast([" ".join(words)], add_special_tokens=False)  # without offsets
        ids = np.array(joint.ids, dtype="<u4")
        cut = split_flags(ids, ends, len(words), first=False)
        if cut is None:
            return None
        raw, at = ids.tobytes(), (cut * 4).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    memo = WordMemo(direct, joined, lambda a, b: a + b, fold=str.lower)
    memo.memo[""] = b""
    return memo


def encode_batch(memo: WordMemo, texts: list[str]) -> Iterator[bytes]:
    """Little-endian id bytes of every text, without an end id."""
    for lo, hi in by_bytes([len(t) + 1 for t in texts], BATCH_BYTES):
        parts = [(i, part) for i in range(lo, hi) for part in segments(texts[i], BATCH_BYTES)]
        plain = [plain_words(part) for _, part in parts]
        known = iter(memo.word_values([w for words in plain if words is not None for w in words]))
        other = [None if words is not None else dropped_space_pieces(part) for words, (_, part) in zip(plain, parts)]
        rest = iter(memo.values([p for pieces in other if pieces is not None for p in pieces]))
        out = [b""] * (hi - lo)
        for (i, _), words, pieces in zip(parts, plain, other):
            out[i - lo] += b"".join(islice(known, len(words)) if pieces is None else islice(rest, len(pieces)))
        yield from out


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, key: str = "doc_id",
                 text: str = "text", end_id: int = END_ID, id_bytes: int = 4) -> DataFrame:
    """One row per piece: key, ``start``, ``length``, ``doc_tokens`` and
    ``ids`` (little-endian, unsigned, of ``id_bytes``), the document's end id
    included."""
    path = path or tokenizer_file("word_bpe_49k.json")
    schema = T.StructType([docs.schema[key], *(T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens")),
                           T.StructField("ids", T.BinaryType())])
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_encoder(path)
        for b in slices(batches):
            rows, starts, tokens, ids, held = [], [], [], [], 0

            def flush() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()),
                     pa.array([len(i) // id_bytes for i in ids], pa.int64()), pa.array(tokens, pa.int64()),
                     pa.array(ids, pa.binary())], names=schema.names)

            for row, raw in enumerate(encode_batch(memo, b.column(1).fill_null("").to_pylist())):
                raw += end
                if id_bytes != 4:
                    raw = np.frombuffer(raw, "<u4").astype(f"<u{id_bytes}").tobytes()
                for at in range(0, len(raw), id_bytes * capacity):
                    rows.append(row)
                    starts.append(at // id_bytes)
                    tokens.append(len(raw) // id_bytes)
                    ids.append(raw[at:at + id_bytes * capacity])
                held += len(raw)
                if held > 8 * BATCH_BYTES:
                    yield flush()
                    rows, starts, tokens, ids, held = [], [], [], [], 0
            if rows:
                yield flush()

    return docs.select(F.col(key), F.col(text).alias("_text")).mapInArrow(run, schema)


def id_width(path: str, end_id: int = END_ID) -> int:
    """Bytes that hold every id of the vocabulary: 2 or 4."""
    return 2 if max(end_id, *load_tokenizer(path).get_vocab().values()) < 1 << 16 else 4


def widened(pieces: DataFrame, id_bytes: int) -> DataFrame:
    """The same rows with ``ids`` of four bytes."""
    if id_bytes == 4:
        return pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            at = b.schema.get_field_index("ids")
            ids = [np.frombuffer(i, f"<u{id_bytes}").astype("<u4").tobytes() for i in b.column(at).to_pylist()]
            yield b.set_column(at, "ids", pa.array(ids, pa.binary()))

    return pieces.mapInArrow(run, pieces.schema)


# -- cutting stock -----------------------------------------------------------
def best_pattern(values: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of the largest total value."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fits = np.searchsorted(widths, np.arange(capacity + 1), "right").tolist()
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := fits[room]:
            gain = best[room - widths[:n]]
            gain += values[:n]
            k = gain.argmax()
            if gain[k] > best[room]:
                best[room], choice[room] = gain[k], k
    pattern = np.zeros(widths.size, np.int64)
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= int(widths[choice[room]])
    return float(best[capacity]), pattern


def fullest(left: np.ndarray, widths: np.ndarray, capacity: int) -> np.ndarray:
    """Bounded knapsack: the widest piece left, then the fullest filling."""
    first = int(np.flatnonzero(left)[-1])
    pattern = np.zeros(widths.size, np.int64)
    pattern[first] = 1
    room = capacity - int(widths[first])
    used: list[np.ndarray | None] = [None] * widths.size
    reach = np.zeros(room + 1, bool)
    reach[0] = True
    for k in range(widths.size - 1, -1, -1):
        w, most = int(widths[k]), int(left[k] - pattern[k])
        if w > room or most <= 0:
            continue
        count = np.full(room + 1, -1)  # fewest pieces of this class that reach a fill
        count[reach] = 0
        for fill in range(w, room + 1):
            if count[fill] < 0 <= count[fill - w] < most:
                count[fill] = count[fill - w] + 1
        used[k], reach = count, count >= 0
        if reach[room]:
            break
    fill = int(np.flatnonzero(reach)[-1])
    for k in range(widths.size):
        if used[k] is not None:
            n = int(used[k][fill])
            pattern[k] += n
            fill -= n * int(widths[k])
    return pattern


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Inverse by Gauss-Jordan elimination with row pivots. Plain row steps: a
    threaded library call can hang in a driver that holds a Spark session."""
    m = matrix.shape[0]
    work = np.concatenate([matrix, np.eye(m)], axis=1)
    for k in range(m):
        pivot = k + int(np.abs(work[k:, k]).argmax())
        if pivot != k:
            work[[k, pivot]] = work[[pivot, k]]
        work[k] /= work[k, k]
        others = work[:, k].copy()
        others[k] = 0
        work -= others[:, None] * work[k]
    return work[:, m:]


def times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return (matrix * vector).sum(1)


def cutting_stock(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ``{width: count}`` with how often each is used; together they
    cover every demand."""
    widths = np.array(sorted(w for w, n in demand.items() if n > 0), dtype=np.int64)
    if not widths.size:
        return []
    need = np.array([demand[int(w)] for w in widths], dtype=np.float64)
    m = widths.size
    columns = [np.where(np.arange(m) == k, capacity // int(w), 0) for k, w in enumerate(widths)]
    inverse = np.diag(1.0 / np.array([c[k] for k, c in enumerate(columns)], dtype=np.float64))
    amount = times(inverse, need)
    for step in range(MAX_PIVOTS):
        if step % 200 == 199:
            inverse = inverted(np.stack(columns, 1).astype(np.float64))
            amount = np.maximum(times(inverse, need), 0)
        duals = inverse.sum(0)
        value, column = best_pattern(duals, widths, capacity)
        if value <= 1 + GAP:
            break
        entering = times(inverse, column)
        up = entering > 1e-9
        if not up.any():
            break
        ratio = np.where(up, amount / np.where(up, entering, 1), np.inf)
        out = int(ratio.argmin())
        amount -= ratio[out] * entering
        amount[out] = ratio[out]
        amount = np.maximum(amount, 0)
        row = inverse[out] / entering[out]
        inverse -= entering[:, None] * row
        inverse[out] = row
        columns[out] = column
    left = need.astype(np.int64)
    plan: list[tuple[dict[int, int], int]] = []

    def use(pattern: np.ndarray, often: int) -> None:
        taken = np.minimum(pattern * often, left)
        if often and taken.any():
            left[:] -= taken
            plan.append(({int(w): int(c) for w, c in zip(widths, pattern) if c}, often))

    for pattern, x in zip(columns, amount):
        fits = min((int(left[k]) // int(pattern[k]) for k in np.flatnonzero(pattern)), default=0)
        use(pattern, min(int(x + 1e-6), fits))
    while left.any():
        pattern = fullest(left, widths, capacity)
        use(pattern, int(min(left[k] // pattern[k] for k in np.flatnonzero(pattern))))
    return plan


def rank_ranges(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(class, first rank, next rank, pieces per sequence, first sequence)``
    for every class of every pattern."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, times in plan:
        for w, c in pattern.items():
            lo = rank.get(w, 0)
            rank[w] = lo + c * times
            out.append((w, lo, lo + c * times, c, sequence))
        sequence += times
    return out


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY, unit: int = UNIT,
                     order: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """``pieces`` (rows with a ``length`` from 1 to ``capacity``) with
    ``sequence_id`` and ``offset`` (gapless within a sequence)."""
    spark = pieces.sparkSession
    rows = materialize(pieces.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    narrow = rows.select("_piece", "length", *order).withColumns({
        "_class": F.ceil(F.col("length") / unit).cast("int"),
        "_split": F.shiftrightunsigned("_piece", 33)})  # the partition that wrote it
    order = (*order, "_piece")
    counts = narrow.groupBy("_class", "_split").agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy("_class").orderBy("_split")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_class", "_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    demand = {r["_class"]: r["n"] for r in counts.groupBy("_class").agg(F.sum("_n").alias("n")).collect()}
    ranges = local_rows(spark, rank_ranges(cutting_stock(demand, capacity // unit)),
                        "_c int, _lo long, _hi long, _per long, _first long")
    within = Window.partitionBy("_class", "_split").orderBy(*order)
    ranked = (narrow.withColumn("_k", F.row_number().over(within) - 1)
              .join(offsets, ["_class", "_split"])
              .withColumn("_rank", F.col("_k") + F.col("_before")))
    # At most (capacity / unit) ** 2 rank ranges, whatever the input.
    placed = ranked.join(F.broadcast(ranges), (F.col("_class") == F.col("_c")) & (F.col("_rank") >= F.col("_lo"))
                         & (F.col("_rank") < F.col("_hi")))
    placed = placed.withColumn("sequence_id", F.col("_first") + F.floor((F.col("_rank") - F.col("_lo")) / F.col("_per")))
    inside = (Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order)
              .rowsBetween(Window.unboundedPreceding, -1))
    places = placed.select("_piece", "sequence_id",
                           F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long").alias("offset"))
    return rows.join(places.hint("shuffle_hash"), "_piece").select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, unit: int = UNIT,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces with their ids and their place; ``ids_crc32`` is taken from the
    ids as they are returned."""
    path = path or tokenizer_file("word_bpe_49k.json")
    id_bytes = id_width(path)
    pieces = token_pieces(docs, path, capacity, key, text, id_bytes=id_bytes)
    packed = widened(assign_sequences(pieces, capacity, unit, (key, "start")), id_bytes)
    return packed.withColumn("ids_crc32", F.crc32("ids"))
