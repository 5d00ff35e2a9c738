"""Hashed text features shared by the trained classifiers: distinct lower-case
runs of letters, of digits and of marks, beginnings of letter runs, and marks
with their counts, hashed to ``2**bits`` buckets, plus a few buckets for the
shape of the whole text (share of capitals, of marks, of repeated words,
immediate repeats, length), so that texts of unseen words are told apart too.
All arithmetic runs on UTF-8 bytes, a megabyte at a time; whole texts are
read."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail.llm.common import BYTE_LOWER, SEGMENT, U64, by_bytes, hash_runs, mix, slices, text_column, utf8

BITS = 18
BEGINNING = 5  # bytes
CHUNK = 1 << 20  # features that a step of the training handles at once
SHAPES = 64  # buckets of shape features, above the hashed ones
#: Classes of bytes: 0 white space and control, 1 letter (all bytes of multi-byte characters), 2 digit, 3 mark.
_KIND = np.full(256, 3, np.uint8)
_KIND[:33] = 0
_KIND[127] = 0
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = 1
_KIND[0x61:0x7B] = 1
_KIND[0x80:] = 1
_STEPS = np.array([0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.65, 0.8, 0.95])


def width(bits: int = BITS) -> int:
    return (1 << bits) + SHAPES


def _runs(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and kinds of the runs of one class."""
    kind = _KIND[buf]
    starts = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1])
    return starts, kind[starts]


def _shape(base: int, letters: int, capitals: int, marks: int, words: int, repeats: int, distinct: int,
           size: int) -> list[int]:
    step = lambda part, whole: int(np.searchsorted(_STEPS, part / max(1, whole)))
    return [base + step(capitals, letters), base + 12 + step(marks, words + marks), base + 24 + step(distinct, words),
            base + 36 + min(15, int(size).bit_length()), base + 52 + step(repeats, words)]


def _beginnings(buf: np.ndarray, starts: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Hashes of the first ``BEGINNING`` bytes of longer letter runs."""
    stops = np.append(starts[1:], buf.size)
    long = (kind == 1) & (stops - starts > BEGINNING)
    values = np.zeros((int(long.sum()), BEGINNING), np.uint64)
    at = starts[long]
    for j in range(BEGINNING):
        values[:, j] = BYTE_LOWER[buf[at + j]] * U64(2 * j + 3)
    return mix(values.sum(1, dtype=np.uint64) + U64(BEGINNING))


def _counted(marks: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hashes of marks with the step of their counts over the whole text."""
    steps = np.log2(counts).astype(np.uint64) if counts.size else counts.astype(np.uint64)
    return mix(marks + steps + U64(1))


def _found(h: np.ndarray, kind: np.ndarray, begin: np.ndarray, shift: np.uint64) -> np.ndarray:
    marks = _counted(*np.unique(h[kind == 3], return_counts=True))
    return np.unique(np.concatenate([h[kind > 0], begin, marks]) >> shift).astype(np.int64)


def features(texts: list[bytes], bits: int = BITS) -> Iterator[np.ndarray]:
    """Sorted distinct feature numbers of every text."""
    base, shift = 1 << bits, U64(64 - bits)
    for lo, hi in by_bytes([len(t) + 1 for t in texts], SEGMENT):
        buf = np.frombuffer(b"\n".join(texts[lo:hi]) + b"\n", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
        starts, kind = _runs(buf) if buf.size <= 2 * SEGMENT else (None, None)
        if starts is None:
            yield _long(texts[lo], bits)
            continue
        hashes = hash_runs(buf, starts, BYTE_LOWER)
        capital = np.concatenate([[0], np.cumsum((buf >= 65) & (buf <= 90))])
        letter = np.concatenate([[0], np.cumsum(_KIND[buf] == 1)])
        at = np.concatenate([[0], ends])
        cut = np.searchsorted(starts, at)
        begin = _beginnings(buf, starts, kind)
        long = np.concatenate([[0], np.cumsum((kind == 1) & (np.diff(np.append(starts, buf.size)) > BEGINNING))])
        for i in range(hi - lo):
            k, h = kind[cut[i]:cut[i + 1]], hashes[cut[i]:cut[i + 1]]
            words = h[k == 1]
            extra = _shape(base, letter[at[i + 1]] - letter[at[i]], capital[at[i + 1]] - capital[at[i]],
                           int((k == 3).sum()), words.size, int((words[1:] == words[:-1]).sum()),
                           np.unique(words).size, ends[i] - at[i])
            yield np.concatenate([_found(h, k, begin[long[cut[i]]:long[cut[i + 1]]], shift), extra])


def _long(text: bytes, bits: int) -> np.ndarray:
    """One text of many megabytes, in parts cut at white space; the same
    features as of the whole at once."""
    buf, at, shift = np.frombuffer(text, np.uint8), 0, U64(64 - bits)
    found, words, marks, totals = [], [], [], np.zeros(5, np.int64)
    last = np.empty(0, U64)  # the last word so far
    while at < buf.size:
        stop = min(at + SEGMENT, buf.size)
        while stop < buf.size and _KIND[buf[stop]]:
            stop += 1
        part = buf[at:stop]
        starts, kind = _runs(part)
        h = hash_runs(part, starts, BYTE_LOWER)
        found.append(np.unique(np.concatenate([h[kind > 0], _beginnings(part, starts, kind)]) >> shift).astype(np.int64))
        marks.append(np.unique(h[kind == 3], return_counts=True))
        run = h[kind == 1]
        words.append(np.unique(run))
        totals += [(_KIND[part] == 1).sum(), ((part >= 65) & (part <= 90)).sum(), (kind == 3).sum(), run.size,
                   (run[1:] == run[:-1]).sum() + int(last.size and run.size and last[0] == run[0])]
        last = run[-1:] if run.size else last
        at = stop
    each, place = np.unique(np.concatenate([m for m, _ in marks]), return_inverse=True)
    counts = np.zeros(each.size, np.int64)
    np.add.at(counts, place, np.concatenate([c for _, c in marks]))
    found.append((_counted(each, counts) >> shift).astype(np.int64))
    distinct = np.unique(np.concatenate(words)).size
    extra = _shape(1 << bits, *totals.tolist(), distinct, buf.size + 1)
    return np.concatenate([np.unique(np.concatenate(found)), extra])


class Ragged:
    """Features of many texts in one array: those of text ``i`` are
    ``flat[at[i]:at[i + 1]]``."""

    def __init__(self, flat: np.ndarray, at: np.ndarray):
        self.flat, self.at = flat, at

    @classmethod
    def of(cls, rows: Ragged | list[np.ndarray]) -> Ragged:
        if isinstance(rows, Ragged):
            return rows
        flat = np.concatenate(rows).astype(np.int32) if rows else np.empty(0, np.int32)
        return cls(flat, np.concatenate([[0], np.cumsum([r.size for r in rows], dtype=np.int64)]))

    def __len__(self) -> int:
        return self.at.size - 1

    def chunks(self) -> Iterator[tuple[int, int]]:
        """Ranges of texts with about ``CHUNK`` features."""
        lo = 0
        while lo < len(self):
            hi = max(lo + 1, int(np.searchsorted(self.at, self.at[lo] + CHUNK, "right")) - 1)
            yield lo, hi
            lo = hi


class Rows(Ragged):
    """Texts' features for training in numpy, numbered by weight. Products
    run over ``chunks``, so that what a step allocates stays small."""

    def __init__(self, rows: Ragged | list[np.ndarray], chosen: np.ndarray):
        """``chosen``: the features that have a weight, sorted."""
        rows = Ragged.of(rows)
        kept, sizes = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for lo, hi in rows.chunks():
            part = rows.flat[rows.at[lo]:rows.at[hi]]
            place = np.minimum(np.searchsorted(chosen, part), max(0, chosen.size - 1))
            known = chosen[place] == part if chosen.size else np.zeros(part.size, bool)
            kept.append(place[known].astype(np.int32))
            sizes.append(np.diff(np.concatenate([[0], np.cumsum(known)])[rows.at[lo:hi + 1] - rows.at[lo]]))
        super().__init__(np.concatenate(kept), np.cumsum(np.concatenate(sizes)))
        self.n, self.width = len(rows), chosen.size

    def dot(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        for lo, hi in self.chunks():
            some = np.flatnonzero(np.diff(self.at[lo:hi + 1]))
            if some.size:
                part = weights[self.flat[self.at[lo]:self.at[hi]]]
                out[lo + some] = np.add.reduceat(part, self.at[lo + some] - self.at[lo])
        return out

    def back(self, values: np.ndarray) -> np.ndarray:
        """Transposed product: the gradient of the weights."""
        out = np.zeros(self.width)
        for lo, hi in self.chunks():
            each = np.repeat(values[lo:hi], np.diff(self.at[lo:hi + 1]))
            out += np.bincount(self.flat[self.at[lo]:self.at[hi]], each, self.width)
        return out


def document_counts(rows: Ragged | list[np.ndarray], total: int) -> np.ndarray:
    """How many rows have each feature."""
    rows, counts = Ragged.of(rows), np.zeros(total)
    for lo, hi in rows.chunks():
        counts += np.bincount(rows.flat[rows.at[lo]:rows.at[hi]], minlength=total)
    return counts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, x: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient ** 2
        return x - self.rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)


# -- Spark -------------------------------------------------------------------
def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int, key: str = "doc_id",
                    text: str = "text") -> tuple[Ragged, list[tuple]]:
    """Features and label values (the other columns of ``labels``) of at most
    ``limit`` labelled documents, those whose ids have the smallest hashes.
    The limit bounds what is broadcast and what reaches the driver."""
    values = [c for c in labels.columns if c != key]
    chosen = (labels.where(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key).limit(limit)
              .select(F.col(key).alias("_key"), F.struct(*values).alias("_label")))
    rows = (docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
            .join(F.broadcast(chosen), F.col("_id") == F.col("_key")).select("_key", "_text", "_label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [f.astype("<i4").tobytes() for f in features(text_column(b, "_text"))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary()), b.column(2)],
                                             names=["_key", "features", "label"])

    schema = T.StructType([rows.schema["_key"], T.StructField("features", T.BinaryType()),
                           T.StructField("label", rows.schema["_label"].dataType)])
    got = rows.mapInArrow(run, schema).toArrow().sort_by("_key")
    found = got.column("features").cast(pa.large_binary()).combine_chunks()
    found = found if isinstance(found, pa.Array) else pa.concat_arrays(found.chunks or [pa.array([], pa.large_binary())])
    ends = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, found.offset * 8) if len(found) else np.zeros(1, np.int64)
    flat = np.frombuffer(found.buffers()[2], "<i4", (ends[-1] - ends[0]) // 4, int(ends[0])) if len(found) else np.empty(0, "<i4")
    return (Ragged(flat, (ends - ends[0]) // 4),
            [tuple(v[c] for c in values) for v in got.column("label").to_pylist()])


def score_texts(docs: DataFrame, score: Callable[[list[np.ndarray]], dict[str, np.ndarray]], names: list[str],
                text: str = "text") -> DataFrame:
    """``row`` (a struct of all columns of ``docs``, so that no name clashes)
    and the double columns ``names`` that ``score`` gives for features. Texts
    are read from the struct: they cross to Python once."""
    rows, at = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), docs.columns.index(text)
    schema = T.StructType([rows.schema["row"], *(T.StructField(n, T.DoubleType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = score(list(features(utf8(b.column(0).field(at)))))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(got[n], pa.float64()) for n in names)],
                                             names=schema.names)

    return rows.mapInArrow(run, schema)
