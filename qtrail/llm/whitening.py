"""Whitening of embeddings on their leading principal components.

Method. Spectrum slicing. The inertia of an L D L^T factorization of the
covariance less a shift counts the eigenvalues above that shift (Sylvester),
so bisection isolates each leading eigenvalue in an interval of its own, or in
one as narrow as double precision for equal ones. From inverse iteration in
the interval, Rayleigh quotient iteration converges cubically; a quotient that
leaves the interval sends it back to a narrower one. The counts just above and
below each value found certify its number. Vectors found are projected out of
the later ones, which keeps equal eigenvalues apart.

Scale. Entries are integers (``floor(1024 c) + 100000``). Tasks sum them, and
then the products of what they differ by from the integer next to their mean
(centred before multiplying), in exact 64-bit integers; Spark sums these by
entry as decimals, so no order of tasks changes a digit and no task gathers
more than ``d * d / 2`` running sums. The driver holds the covariance (``d``
by ``d``, whatever the rows) and sends the components with the code.
Factorizations and solutions are plain row steps: a threaded library call can
hang in a driver that holds a Spark session.

Defined results: rows whose vector is null, empty, or holds a null or a
non-finite entry are dropped; vectors of another length are a fit list of
their own (their ``n``, components and errors are those of their length);
repeated rows and ids count as often as they stand there; components whose
variance is 0 to double precision have no whitened values and are left out;
an empty table gives an empty result; entries c beyond 2 ** 19 in size raise
an error. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail.llm.common import materialize

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = 1 << 29  # of 1024 c: products of two distances fit 62 bits
EXACT = 1 << 62


@dataclass(frozen=True)
class Whitener:
    """Fit of the vectors of one length: ``n`` of them with integer sums
    ``total``; ``components`` (rows, by falling ``variances``)."""
    n: int
    total: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def middle(self) -> list[int]:
        return [nearest(s, self.n) for s in self.total]


def nearest(total: int, n: int) -> int:
    """The integer next to ``total / n``."""
    return (2 * total + n) // (2 * n)


# -- integer vectors ---------------------------------------------------------
def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vectors`` with ``_x``, the vector as doubles, without those rows that
    have none."""
    x = F.col(f"`{vector}`").cast(T.ArrayType(T.DoubleType()))
    # Not null, not NaN (greater than all else) and not infinite.
    finite = F.forall(x, lambda c: c.isNotNull() & (c < F.lit(float("inf"))) & (c > F.lit(float("-inf"))))
    return vectors.withColumn("_x", F.when(finite & (F.size(x) > 0), x)).where(F.col("_x").isNotNull())


def integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, x)`` for each length in a column of vectors."""
    lengths = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        x = np.floor(flat[starts[rows][:, None] + np.arange(d)] * SCALE)
        if np.abs(x).max(initial=0) > LARGEST:
            raise ValueError(f"entries beyond {LARGEST // SCALE} in size have no exact products")
        yield rows, x.astype(np.int64) + SHIFT


def summed(vectors: DataFrame, middles: dict[int, list[int]] | None) -> dict[tuple[int, int, int], int]:
    """Exact sums over all vectors by length ``d``: without ``middles`` of the
    entries (``d, i, -1``) and of the rows (``d, -1, -1``); with them of the
    products of the entries' distances from them (``d, i, j``, i <= j)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size: dict[int, int] = {}

        def out(d: int) -> pa.RecordBatch:
            if middles is None:
                i, value = np.arange(-1, d), held.pop(d)
                j = np.full(d + 1, -1)
            else:
                i, j = np.triu_indices(d)
                value = held.pop(d)[i, j]
            size.pop(d)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(i.size, d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array(value, pa.int64())], names=["d", "i", "j", "value"])

        for b in batches:
            for at in range(0, b.num_rows, 4096):
                for rows, x in integers(b.column(0).slice(at, 4096)):
                    d = x.shape[1]
                    y = x if middles is None else x - np.array(middles[d])
                    most = int(np.abs(y).max(initial=1)) ** (1 if middles is None else 2)
                    step = max(1, EXACT // most // 2)
                    for lo in range(0, rows.size, step):
                        part = y[lo:lo + step]
                        if d in held and size[d] + most * part.shape[0] > EXACT:
                            yield out(d)
                        more = (np.concatenate([[part.shape[0]], part.sum(0)]) if middles is None else part.T @ part)
                        held[d] = held[d] + more if d in held else more
                        size[d] = size.get(d, 0) + most * part.shape[0]
        for d in list(held):
            yield out(d)

    parts = vectors.select("_x").mapInArrow(run, "d int, i int, j int, value long")
    total = parts.groupBy("d", "i", "j").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    return {(r["d"], r["i"], r["j"]): int(r["value"]) for r in total.toLocalIterator()}


# -- spectrum slicing --------------------------------------------------------
def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: positive
    pivots of L D L^T of the shifted matrix, with 1 x 1 and 2 x 2 pivots."""
    a = matrix - shift * np.eye(matrix.shape[0])
    positive = 0
    while a.size:
        size = np.abs(a)
        k = int(np.diagonal(size).argmax())
        p, q = divmod(int(size.argmax()), a.shape[0])
        largest = size[p, q]
        if largest == 0:
            break
        if size[k, k] >= 0.64 * largest:
            positive += bool(a[k, k] > 0)
            rest = np.delete(np.arange(a.shape[0]), k)
            col = a[rest, k]
            a = a[np.ix_(rest, rest)] - (col / a[k, k])[:, None] * col
        else:  # its pivot block has one eigenvalue of either sign
            positive += 1
            rest = np.delete(np.arange(a.shape[0]), [p, q])
            u, v = a[rest, p], a[rest, q]
            det = a[p, p] * a[q, q] - a[p, q] ** 2
            left = (a[q, q] * u - a[p, q] * v) / det
            right = (a[p, p] * v - a[p, q] * u) / det
            a = a[np.ix_(rest, rest)] - left[:, None] * u - right[:, None] * v
    return positive


def solved(matrix: np.ndarray, vector: np.ndarray, tiny: float) -> np.ndarray:
    """Solution of a linear system by elimination with row pivots; a pivot
    under ``tiny`` (the shift is an eigenvalue) counts as ``tiny``."""
    d = vector.size
    work = np.concatenate([matrix, vector[:, None]], axis=1)
    for k in range(d):
        pivot = k + int(np.abs(work[k:, k]).argmax())
        if pivot != k:
            work[[k, pivot]] = work[[pivot, k]]
        if abs(work[k, k]) < tiny:
            work[k, k] = tiny
        work[k + 1:] -= (work[k + 1:, k] / work[k, k])[:, None] * work[k]
    out = np.zeros(d)
    for k in range(d - 1, -1, -1):
        out[k] = (work[k, d] - (work[k, k + 1:d] * out[k + 1:]).sum()) / work[k, k]
    return out


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues above 0 (to double precision) of a
    covariance, falling, and their unit vectors as rows."""
    d = matrix.shape[0]
    scale = float(np.abs(matrix).sum(1).max())  # no eigenvalue is larger
    if not scale:
        return np.empty(0), np.empty((0, d))
    floor = 4 * d * np.finfo(float).eps * scale
    known = {floor: eigenvalues_above(matrix, floor), scale * (1 + 1e-9): 0}

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = eigenvalues_above(matrix, shift)
        return known[shift]

    def unit(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for w in vectors:
                v = v - (w * v).sum() * w
        return v / np.sqrt((v * v).sum())

    values: list[float] = []
    vectors: list[np.ndarray] = []
    rng = np.random.default_rng(7)
    for k in range(1, min(count, known[floor]) + 1):
        low = max(s for s, n in known.items() if n >= k)
        high = min(s for s, n in known.items() if n < k)

        def halve(low: float, high: float) -> tuple[float, float]:
            mid = (low + high) / 2
            return (mid, high) if above(mid) >= k else (low, mid)

        while high - low > floor and (above(low) != k or above(high) != k - 1):
            low, high = halve(low, high)
        v, shift, narrowed = unit(rng.normal(size=d)), (low + high) / 2, 0
        for step in range(200):
            v = unit(solved(matrix - shift * np.eye(d), v, np.finfo(float).eps * scale))
            image = (matrix * v).sum(1)
            value = float((v * image).sum())
            lost = np.sqrt(((image - value * v) ** 2).sum())
            inside = low - floor <= value <= high + floor
            if inside and lost <= floor / 2:
                break
            if inside and step - narrowed >= 2:
                shift = value  # Rayleigh quotient iteration
            elif not inside:
                if high - low > floor:
                    low, high = halve(low, high)
                shift, narrowed = (low + high) / 2, step
        if not inside or lost > 64 * floor:
            raise ArithmeticError(f"component {k} did not converge")
        values.append(value)
        vectors.append(v)
    for k, value in enumerate(values, 1):  # counts on both sides certify the number
        if not eigenvalues_above(matrix, value + 8 * floor) < k <= eigenvalues_above(matrix, value - 8 * floor):
            raise ArithmeticError(f"component {k} is not eigenvalue {k}")
    return np.array(values), np.array(vectors)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """A whitener for each length of the vectors (rows of ``usable``)."""
    totals = summed(vectors, None)
    n = {d: v for (d, i, _), v in totals.items() if i < 0}
    total = {d: [totals[d, i, -1] for i in range(d)] for d in n}
    middles = {d: [nearest(s, n[d]) for s in total[d]] for d in n}
    products = summed(vectors, middles) if n else {}
    out = {}
    for d in n:
        # Exact: sums of products about the integers, less those of the means' fractions.
        off = [s - n[d] * m for s, m in zip(total[d], middles[d])]
        cov = np.empty((d, d))
        for i in range(d):
            for j in range(i, d):
                cov[i, j] = cov[j, i] = (n[d] * products[d, i, j] - off[i] * off[j]) / (n[d] * n[d])
        values, axes = leading_components(cov, components)
        out[d] = Whitener(n[d], total[d], axes, values, float(np.trace(cov)))
    return out


# -- whitened rows -----------------------------------------------------------
def whitened(vectors: DataFrame, model: dict[int, Whitener], key: str = "vec_id") -> DataFrame:
    """``key, d, n, deviation, whitened`` of each row of ``usable``:
    ``deviation`` is exact, ``whitened`` an array by component."""
    of_key = vectors.schema[key]
    schema = T.StructType([of_key, T.StructField("d", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.DecimalType(38, 0)),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                for rows, x in integers(part.column(1)):
                    m = model[x.shape[1]]
                    middle = m.middle
                    off = [s - m.n * c for s, c in zip(m.total, middle)]  # n * mean less n * middle
                    y = x - np.array(middle)
                    most = int(np.abs(y).max(initial=1))
                    exact = np.int64 if most * max(most, *map(abs, off)) * y.shape[1] < EXACT else object
                    square, cross = (y.astype(exact) ** 2).sum(1), (y.astype(exact) * np.array(off, dtype=exact)).sum(1)
                    rest = sum(o * o for o in off)
                    far = [m.n * m.n * int(a) - 2 * m.n * int(c) + rest for a, c in zip(square, cross)]
                    z = y - np.array([o / m.n for o in off])
                    w = np.einsum("rd,kd->rk", z, m.components) / np.sqrt(m.variances)
                    k = m.variances.size
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(rows.size + 1) * k, pa.int32()), pa.array(w.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(rows)), pa.array(np.full(rows.size, x.shape[1]), pa.int32()),
                         pa.array(np.full(rows.size, m.n), pa.int64()),
                         pa.array([Decimal(f) for f in far], pa.decimal128(38, 0)), lists], names=schema.names)

    return vectors.select(F.col(f"`{key}`"), "_x").mapInArrow(run, schema)


def identity_errors(rows: DataFrame, components: int = COMPONENTS) -> dict[int, float]:
    """By length, the largest absolute entry of the covariance of ``whitened``
    less the identity, taken from the whitened rows themselves."""
    def at(k: int):
        return F.get("whitened", F.lit(k))

    means = rows.groupBy("d").agg(*[F.avg(at(k)).alias(f"m{k}") for k in range(components)])
    centred = rows.join(means, "d").select("d", *[(at(k) - F.col(f"m{k}")).alias(f"c{k}") for k in range(components)])
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    cov = centred.groupBy("d").agg(*[F.avg(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"v{i}_{j}") for i, j in pairs])
    worst = F.greatest(F.lit(0.0), *[F.abs(F.col(f"v{i}_{j}") - (1.0 if i == j else 0.0)) for i, j in pairs])
    return {r["d"]: r["worst"] for r in cov.select("d", worst.alias("worst")).collect()}


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``:
    one row for each usable vector and component."""
    rows = usable(vectors.select(F.col(f"`{key}`"), F.col(f"`{vector}`")), vector)
    model = fit(rows, components)
    table = materialize(whitened(rows, model, key), "whitened")
    errors = identity_errors(table, components)

    def by_length(value: dict, kind: str):
        out = F.lit(None).cast(kind)
        for d, x in value.items():
            out = F.when(F.col("d") == d, F.lit(x).cast(kind)).otherwise(out)
        return out

    share = by_length({d: [float(v / m.trace) for v in m.variances] for d, m in model.items() if m.variances.size},
                      "array<double>")
    return (table.select(F.col(f"`{key}`"), "n", "deviation", share.alias("_share"),
                         by_length(errors, "double").alias("identity_error"),
                         F.posexplode("whitened").alias("_at", "whitened"))
            .select(F.col(f"`{key}`"), (F.col("_at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                    F.get("_share", F.col("_at")).alias("explained"), "identity_error"))
