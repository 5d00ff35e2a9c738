"""Small helpers the operators share: scratch tables, tokenizer paths,
byte-balanced slicing and the hashing of words on raw UTF-8 bytes."""

from __future__ import annotations

import importlib.util
import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from qtrail.session import scratch_path

U64 = np.uint64


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file: the installed ``public_tokenizers``
    package, or the folder named by ``QTRAIL_TOKENIZERS``."""
    root = os.environ.get("QTRAIL_TOKENIZERS")
    if root is None and importlib.util.find_spec("public_tokenizers") is not None:
        import public_tokenizers
        return public_tokenizers.path(name)
    return os.path.join(root or "/opt/tokenizers", name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    lineage is cut, later jobs survive lost executors without recomputing."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_bytes(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ``(start, stop)`` slices whose sizes sum to ``limit`` at
    most (a single larger item stands alone)."""
    start, total, stop = 0, 0, 0
    for stop, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, stop
            start, total = stop, 0
        total += n
    if total or start <= stop and sizes:
        yield start, stop + 1


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: what a task builds from a batch of
    texts stays small beside the batch itself."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def utf8(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of texts, null as empty."""
    return texts.fill_null("").cast(pa.large_binary()).to_pylist()


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return utf8(batch.column(name))


# -- word hashing ------------------------------------------------------------
# A word is a maximal run of bytes other than space, tab, LF, VT, FF, CR. Its
# hash is a polynomial over random 64-bit byte values modulo 2**64, taken for
# all words of a buffer at once and finished with an avalanche step.
_RNG = np.random.default_rng(20240117)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BYTE_LOWER = _BYTE.copy()
BYTE_LOWER[65:91] = _BYTE[97:123]
BYTE_LOWER[_SPACE] = 0
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_SHINGLE = _RNG.integers(1, 2**63, 8, dtype=np.uint64) * U64(2) + U64(1)
SEGMENT = 1 << 19  # bytes hashed at once


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit avalanche of an unsigned array."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        out[1:] = U64(base & (2**64 - 1))
        return np.multiply.accumulate(out)
    return table(_BASE), table(pow(_BASE, -1, 2**64))


def hash_runs(buf: np.ndarray, starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hash of every run ``starts[i]:starts[i+1]`` of ``buf``; bytes whose
    value is 0 do not count."""
    size = max(SEGMENT, 1 << int(buf.size).bit_length()) if buf.size else SEGMENT
    power, inverse = _powers(size)
    return mix(np.add.reduceat(values[buf] * power[: buf.size], starts) * inverse[starts])


def _segments(buf: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces of about SEGMENT bytes that end at white space."""
    at = 0
    while at < buf.size:
        stop = min(at + SEGMENT, buf.size)
        while stop < buf.size and not _SPACE[buf[stop]]:
            gap = np.flatnonzero(_SPACE[buf[stop:stop + SEGMENT]])
            stop = stop + int(gap[0]) if gap.size else min(stop + SEGMENT, buf.size)
        yield buf[at:stop]
        at = stop


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word of a whole text, in order, A-Z taken as a-z."""
    out = []
    for buf in _segments(np.frombuffer(text, np.uint8)):
        word = ~_SPACE[buf]
        first = word.copy()
        first[1:] &= ~word[:-1]
        starts = np.flatnonzero(first)
        if starts.size:
            out.append(hash_runs(buf, starts, BYTE_LOWER))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def batch_word_hashes(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, word hashes)`` for every text; short texts are hashed together."""
    for lo, hi in by_bytes([len(t) + 1 for t in texts], SEGMENT):
        if hi - lo == 1:
            yield lo, word_hashes(texts[lo])
            continue
        buf = np.frombuffer(b" ".join(texts[lo:hi]), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
        word = ~_SPACE[buf]
        first = word.copy()
        first[1:] &= ~word[:-1]
        starts = np.flatnonzero(first)
        hashes = hash_runs(buf, starts, BYTE_LOWER) if starts.size else np.empty(0, np.uint64)
        cut = np.concatenate([[0], np.searchsorted(starts, ends)])
        for i in range(hi - lo):
            yield lo + i, hashes[cut[i]:cut[i + 1]]


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter
    sequence is one shingle, no words give none."""
    n = words.size
    if not n:
        return words
    if n < size:
        return mix((words * _SHINGLE[:n]).sum(dtype=np.uint64, keepdims=True) + U64(n))
    total = words[: n - size + 1] * _SHINGLE[0]
    for j in range(1, size):
        total += words[j: n - size + 1 + j] * _SHINGLE[j]
    return np.unique(mix(total))


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small driver-made table."""
    return spark.createDataFrame(rows, schema)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package's source to the executors (once per application), so
    that their workers import the functions this subpackage sends them."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        import qtrail
        home = os.path.dirname(os.path.abspath(qtrail.__file__))
        folder = tempfile.mkdtemp(prefix="qtrail-")
        sc.addPyFile(shutil.make_archive(f"{folder}/qtrail-src", "zip", os.path.dirname(home), "qtrail"))
        _SHIPPED.add(sc.applicationId)
