"""Approximate nearest neighbours by multi-index hashing.

Method. On a bounded sample (``sample_rows`` vectors of the smallest id
hashes) the driver learns binary codes: centre, principal axes and a rotation
fitted so that signs lose little (iterative quantization), once per block of
``dim`` bits. A code is cut into substrings, each indexed by its value. Two
codes within Hamming distance r agree within floor(r / m) in one of m
substrings at least (pigeonhole), so probing every substring's index at that
distance retrieves every code within r; what was retrieved is checked on the
whole code, and survivors are ranked by exact double-precision distances of
the original vectors.

The radius is learned too: within the sample, the Hamming distance that covers
``coverage`` of true neighbours. A query that finds fewer than k rows in a
block probes on with a larger radius, so nothing depends on the radius but
recall (tests and README measure it against brute force).

Scale. Rows are dealt by id hash into blocks of bounded size, queries into
blocks as well; a task takes one index block and one query block, keeps its k
best per query, and the best of all blocks are ranked. Copies of one vector
spread over all blocks. Nothing but the codes' model goes to the driver.

Defined results: null, zero, non-finite or null-holding vectors take no part,
nor do vectors whose length is not the most common one of the sample (ties to
the longer); null ids take no part; equal distances go to the smaller id;
repeated ids count as rows of their own, but for the query's own id; equal
query rows (id and vector) are asked once, different vectors under one query
id each have their own k neighbours, ranked apart; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
BLOCK_ROWS = 8_192
QUERY_BLOCK = 1_024
ROTATIONS = 2  # codes of ROTATIONS * dimension bits
SUBSTRING = 16  # bits
COVERAGE = 0.97
NEIGHBOURS = 10
_BITS = np.array([bin(i).count("1") for i in range(1 << SUBSTRING)], np.uint8)


@dataclass(frozen=True)
class BinaryCodes:
    mean: np.ndarray
    projection: np.ndarray  # dimension x bits
    radius: int

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Substrings (16-bit) of the codes of the rows of ``x``."""
        bits = (x - self.mean) @ self.projection >= 0
        pad = -bits.shape[1] % SUBSTRING
        bits = np.pad(bits, ((0, 0), (0, pad)))
        return np.packbits(bits, axis=1).view(">u2").astype(np.uint16)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all codes of ``a`` to all of ``b``."""
    out = np.zeros((a.shape[0], b.shape[0]), np.uint16)
    for j in range(a.shape[1]):
        out += _BITS[a[:, j, None] ^ b[None, :, j]]
    return out


def squared(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return (queries ** 2).sum(1)[:, None] - 2 * queries @ rows.T + (rows ** 2).sum(1)[None, :]


def learn(sample: np.ndarray, rotations: int = ROTATIONS, coverage: float = COVERAGE, steps: int = 30,
          seed: int = 7) -> BinaryCodes:
    rng = np.random.default_rng(seed)
    mean = sample.mean(0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred.T @ centred)
    z = centred @ axes.T
    parts = []
    for _ in range(rotations):
        rotation, _ = np.linalg.qr(rng.normal(size=(z.shape[1], z.shape[1])))
        for _ in range(steps):
            u, _, v = np.linalg.svd(np.where(z @ rotation >= 0, 1.0, -1.0).T @ z)
            rotation = (u @ v).T
        parts.append(axes.T @ rotation)
    model = BinaryCodes(mean, np.concatenate(parts, 1), 0)
    some = sample[: min(len(sample), 200)]
    near = squared(some, sample)
    near[np.arange(len(some)), np.arange(len(some))] = np.inf
    k = min(NEIGHBOURS, len(sample) - 1)
    radius = 0
    if k > 0:
        best = np.argpartition(near, k - 1, axis=1)[:, :k]
        code = model.encode(sample)
        found = np.take_along_axis(hamming(code[: len(some)], code), best, 1)
        radius = int(np.quantile(found, coverage, method="higher"))
    return BinaryCodes(mean, model.projection, radius)


class MultiIndex:
    """Rows of one block under every substring's value: a directory of the
    values that occur, and each row's place in it."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = [np.unique(codes[:, j], return_inverse=True) for j in range(codes.shape[1])]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows within ``radius`` of ``code``. At such radii there are
        more probes to make than values occur, so all probes of a substring go
        through its directory at once."""
        hit = np.zeros(self.codes.shape[0], bool)
        reach = radius // self.codes.shape[1]
        for j, (values, place) in enumerate(self.tables):
            hit |= (_BITS[values ^ code[j]] <= reach)[place]
        rows = np.flatnonzero(hit)
        return rows[_BITS[self.codes[rows] ^ code].sum(1) <= radius]


def search_block(model: BinaryCodes, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray,
                 queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries, row ids and distances: the k best of this block for each."""
    index, codes = MultiIndex(model.encode(vectors)), model.encode(queries)
    bits = model.projection.shape[1]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q in range(query_ids.size):
        radius = model.radius
        while True:
            rows = index.within(codes[q], radius)
            rows = rows[ids[rows] != query_ids[q]]
            if rows.size >= k or radius >= bits:
                break
            radius = min(bits, radius + max(1, bits // 16))
        distance = np.sqrt(((vectors[rows] - queries[q]) ** 2).sum(1))
        best = np.lexsort((ids[rows], distance))[:k]
        out.append((np.full(best.size, q), ids[rows][best], distance[best]))
    if not out:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0)
    return tuple(np.concatenate(c) for c in zip(*out))  # type: ignore[return-value]


# -- Spark -------------------------------------------------------------------
def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id`` and ``v`` (doubles) of the vectors that take part."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine
                      & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(rows), -1) if len(rows) else np.empty((0, 0))


def train(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[BinaryCodes, int] | None:
    """The codes and the dimension; None where there are no rows."""
    got = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).toArrow()
    lengths = Counter(len(v) for v in got.column("v"))
    if not lengths:
        return None
    dim = max(lengths, key=lambda n: (lengths[n], n))
    sample = np.array([v.as_py() for v in got.column("v") if len(v) == dim])
    return learn(sample), dim


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, key: str = "vec_id",
            vector: str = "embedding", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest rows found; a query's
    own id is no candidate."""
    rows, asked = usable(vectors, key, vector), usable(queries, key, vector)
    trained = train(rows, sample_rows)
    asked = asked.dropDuplicates(["id", "v"]).withColumn("query", F.xxhash64("v"))
    schema = "query_id long, query long, vec_id long, score double"
    if trained is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    model, dim = trained
    rows, asked = rows.where(F.size("v") == dim), asked.where(F.size("v") == dim)
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"),
                       spread(query_blocks).alias("asked"))
    right = asked.select("id", "query", "v", spread(blocks).alias("block"),
                         F.pmod(F.xxhash64("id", "query"), F.lit(query_blocks)).cast("int").alias("asked"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows and b.num_rows:
            got = search_block(model, a.column("id").to_numpy(), _matrix(a.column("v")), b.column("id").to_numpy(),
                               _matrix(b.column("v")), k)
        else:
            got = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({"query_id": b.column("id").take(pa.array(got[0])), "query": b.column("query").take(pa.array(got[0])),
                         "vec_id": got[1], "score": got[2]})

    found = (left.groupBy("block", "asked").cogroup(right.groupBy("block", "asked")).applyInArrow(run, schema))
    best = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
