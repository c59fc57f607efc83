"""Embedding whitening: an exact covariance by polarisation, its eigenvectors, and unit-variance projections.

For integer vectors x, the sums of squares of every centred dimension and of every sum of two centred dimensions are
counted exactly. As (a + b)^2 - a^2 - b^2 = 2ab, differences of these variances are the covariances. Tasks subtract the
integer next to the mean before they square; what is left of the mean, less than one, is taken off at the end:

    sum (n x - S)^2 = n^2 sum z^2 - n r^2    with z = x - m, m = round(S / n), r = S - n m

One row of sums leaves each task and Spark adds them up. Only the d (d + 1) / 2 totals reach the driver, for `eigh`;
their number depends on the dimension, not on the rows.

Defined results: rows whose vector is null, or holds null or non-finite entries, take no part; neither do vectors of
another length than the most frequent one (the longer of equally frequent ones), nor empty ones. A null id stays a null
id and repeated rows count each time. Without rows the result is empty. A component without variance cannot be
whitened: its values are null. Sums of any size are exact; a deviation that does not fit its type is an error. An entry
of 2^53 / 1024 or more is an error, as its square would not be one of a double's exact steps. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import ship_package, stored

SCALE, SHIFT = 1024, 100_000
MAX_COMPONENTS = 8
# Entries of a block that a task works on at a time, which bounds its memory.
BLOCK = 1 << 20
LARGEST = 1 << 53
EXACT = "decimal(38,0)"


def quantized(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and x, the vector as longs: floor(1024 * entry) + 100000. Unusable vectors are left out."""
    value = F.col(vector)
    finite = F.forall(value, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    exact = F.transform(value, lambda c: _exact_floor(c.cast("double")) + SHIFT)
    return df.where(F.coalesce(finite & (F.size(value) > 0), F.lit(False))).select(F.col(vec_id).alias("vec_id"), exact.alias("x"))


def _exact_floor(entry: Column) -> Column:
    scaled = F.floor(entry * SCALE)
    too_large = F.raise_error(F.lit("an entry is too large to be whitened exactly")).cast("long")
    return F.when(F.abs(entry) * SCALE < float(LARGEST), scaled).otherwise(too_large)


def _of_length(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The vectors of the most frequent length, and that length; 0 without any."""
    found = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = found["d"] if found else 0
    return vectors.where(F.size("x") == d), d


def _blocks(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    flat = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False)
    rows = flat.reshape(-1, d)
    step = max(1, BLOCK // d)
    for at in range(0, len(rows), step):
        yield rows[at : at + step]


def _squarable(z: np.ndarray, times: int) -> np.ndarray:
    """`z`, as Python integers where sums of `times` of its squares might leave 64 bits."""
    largest = int(np.abs(z).max(initial=0))
    return z if times * largest * largest < 1 << 62 else z.astype(object)


def _totals(df: DataFrame, function, length: int) -> list[int]:
    """Sums over all tasks of the `length` exact numbers that `function` makes of the batches of each."""
    kind = pa.list_(pa.decimal128(38))

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import decimal

        found, any_rows = np.zeros(length, dtype=object), False
        for batch in batches:
            found, any_rows = found + function(batch), any_rows or batch.num_rows > 0
        if any_rows:
            values = pa.array([[decimal.Decimal(int(v)) for v in found]], kind)
            yield pa.RecordBatch.from_arrays([values], ["sums"])

    ship_package(df.sparkSession)
    parts = df.mapInArrow(summed, f"sums array<{EXACT}>").select(F.posexplode("sums").alias("i", "v"))
    rows = parts.groupBy("i").agg(F.sum("v").cast(EXACT).alias("v")).collect()
    out = [0] * length
    for row in rows:
        out[row["i"]] = int(row["v"])
    return out


def dimension_sums(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """How many vectors there are, and the sum of each dimension."""

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros(d + 1, dtype=object)
        for x in _blocks(batch, d):
            out[0] += len(x)
            out[1:] += x.sum(axis=0).astype(object)  # at most 2^20 entries of under 2^53 a block, and less a dimension
        return out

    n, *totals = _totals(vectors, sums, d + 1)
    return n, totals


def squared_sums(vectors: DataFrame, middle: list[int]) -> dict[tuple[int, int], int]:
    """sum z_i^2 at (i, i) and sum (z_i + z_j)^2 at (i, j), i < j, where z = x - middle."""
    d = len(middle)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros(len(pairs), dtype=object)
        for x in _blocks(batch, d):
            z = _squarable(x - np.array(middle, dtype=np.int64), 4 * len(x))
            at = 0
            for i in range(d):
                both = z[:, i:] + z[:, i : i + 1]
                both[:, 0] = z[:, i]
                out[at : at + d - i] += (both * both).sum(axis=0).astype(object)
                at += d - i
        return out

    return dict(zip(pairs, _totals(vectors, sums, len(pairs))))


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: n vectors, their rounded mean and its remainder, and components by falling eigenvalue."""

    n: int
    middle: tuple[int, ...]
    rest: tuple[int, ...]
    eigenvalues: tuple[float, ...]
    trace: float
    components: tuple[tuple[float, ...], ...]

    @property
    def explained(self) -> list[float | None]:
        return [e / self.trace if self.trace > 0 else None for e in self.eigenvalues]


def covariance(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariances (divisor n) from sums of squares, each rounded once, at the end."""
    d = len(rest)

    def centred(i: int, j: int) -> int:
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * n * squares[i, j] - n * r * r

    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = centred(i, i) / n**3
        for j in range(i + 1, d):
            out[i, j] = out[j, i] = (centred(i, j) - centred(i, i) - centred(j, j)) / (2 * n**3)
    return out


def fit(vectors: DataFrame, components: int = MAX_COMPONENTS) -> Whitening | None:
    """The whitening of all `vectors` (from `quantized`); None without any."""
    vectors, d = _of_length(vectors)
    if not d:
        return None
    n, sums = dimension_sums(vectors, d)
    middle = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    matrix = covariance(n, rest, squared_sums(vectors, middle))
    values, columns = np.linalg.eigh(matrix)
    kept = np.argsort(-values, kind="stable")[:components]
    return Whitening(
        n, tuple(middle), tuple(rest), tuple(float(values[k]) for k in kept), float(np.trace(matrix)),
        tuple(tuple(map(float, columns[:, k])) for k in kept),
    )


def project(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (sum of (n x - S)^2, exact) and whitened, an array with a value for each component."""
    d, n = len(model.middle), model.n
    largest = max(model.eigenvalues[0], 0.0)
    usable = [e > largest * d * np.finfo(float).eps for e in model.eigenvalues]
    axes = np.array(model.components).T / np.sqrt([e if ok else np.nan for e, ok in zip(model.eigenvalues, usable)])
    middle, rest = np.array(model.middle, dtype=np.int64), np.array(model.rest, dtype=object)
    schema = pa.schema([("vec_id", pa.int64()), ("deviation", pa.decimal128(38)), ("whitened", pa.list_(pa.float64()))])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import decimal

        for batch in batches:
            ids, at = batch.column(batch.schema.get_field_index("vec_id")), 0
            for x in _blocks(batch, d):
                z = x - middle
                wide = (int(np.abs(z).max(initial=0)) + 1) * n * d
                y = n * z - rest.astype(np.int64) if wide * wide < 1 << 62 else n * z.astype(object) - rest
                deviation = (y * y).sum(axis=1)
                whitened = (y / n).astype(np.float64) @ axes
                ends = np.arange(0, whitened.size + 1, whitened.shape[1], dtype=np.int32)
                values = pa.array(whitened.ravel(), mask=np.isnan(whitened.ravel()))
                exact = pa.array([decimal.Decimal(int(v)) for v in deviation], schema[1].type)
                columns = [ids.slice(at, len(x)).cast(pa.int64()), exact, pa.ListArray.from_arrays(ends, values)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                at += len(x)

    ship_package(vectors.sparkSession)
    kept = vectors.where(F.size("x") == d)
    return kept.mapInArrow(rows, f"vec_id long, deviation {EXACT}, whitened array<double>")


def identity_error(projected: DataFrame, components: int) -> float | None:
    """Largest absolute entry of the whitened values' covariance minus the identity; null components take no part."""
    part = [F.col("whitened")[i] for i in range(components)]
    means = projected.agg(*[F.avg(p) for p in part]).first()
    centred = [p - F.lit(m) for p, m in zip(part, means) if m is not None]
    pairs = [(i, j) for i in range(len(centred)) for j in range(i, len(centred))]
    if not pairs:
        return None
    found = projected.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, found))


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, components: int = MAX_COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Fit on all rows of `df` and project them: one row for each vector and component, numbered from 1.

    Columns: vec_id, component, n, deviation, whitened, explained (share of the variance), identity_error.
    """
    vectors = quantized(df, vec_id, vector)
    model = fit(vectors, components)
    if model is None:
        return df.sparkSession.createDataFrame([], RESULT)
    projected = stored(project(vectors, model), "whitened")
    error = identity_error(projected, len(model.components))
    explained = F.array(*[F.lit(e).cast("double") for e in model.explained])
    flat = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return flat.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"), "whitened", F.get(explained, F.col("k")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
