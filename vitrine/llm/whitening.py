"""Embedding whitening: moments merged pair by pair, components on the driver, an identity check in a second pass.

Each task reduces its vectors to a count, a local mean and a centred scatter matrix; two of these are merged by Chan's formula in a tree. What
reaches the driver is one matrix of ``dims x dims``, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import cut, scan

#: Vectors are put on a grid: x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Entries beyond it have no exact place on the grid in doubles; they count as not finite.
MOST_ENTRY = 2.0**40
#: Eigenvalues at or below this share of their sum are noise of the arithmetic: such directions hold no variance and give no component.
LEAST_SHARE = 1e-11


def on_grid(vector: str = "embedding") -> Column:
    """The vector's grid points as ``array<bigint>``; null if it is null or empty, or has an entry that is null, not finite or beyond ``MOST_ENTRY``."""
    c = F.col(vector).cast("array<double>")
    odd = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > MOST_ENTRY))
    return F.when(c.isNotNull() & (F.size(c) > 0) & ~odd, F.transform(c, lambda v: F.floor(v * SCALE) + OFFSET))


@dataclass
class Moments:
    """Count, mean and centred scatter (sum of outer products of what is left of the mean) of some vectors, and their exact sums."""

    n: int
    sums: list[int]
    mean: np.ndarray
    scatter: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray, sums: list[int] | None = None) -> Moments:
        mean = rows.mean(axis=0)
        centred = rows - mean
        return cls(len(rows), sums or [], mean, centred.T @ centred)

    def merge(self, other: Moments) -> Moments:
        n = self.n + other.n
        step = other.mean - self.mean
        scatter = self.scatter + other.scatter + np.outer(step, step) * (self.n * other.n / n)
        return Moments(n, [a + b for a, b in zip(self.sums, other.sums)], self.mean + step * (other.n / n), scatter)


def matrix(column: pa.Array) -> np.ndarray:
    """An Arrow column of lists of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def moments(df: DataFrame, vector: str) -> Moments | None:
    """Moments of a column of equally long vectors; None without rows. Integers keep their exact sums."""
    ship(df.sparkSession)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for b in batches:
            rows = matrix(b.column(0))
            if len(rows):
                sums = [int(s) for s in rows.sum(axis=0, dtype=np.int64)] if rows.dtype.kind == "i" else []
                part = Moments.of((rows - OFFSET if rows.dtype.kind == "i" else rows).astype(np.float64), sums)
                found = part if found is None else found.merge(part)
        if found is not None:
            yield pa.RecordBatch.from_pydict(
                {"n": [found.n], "sums": [[str(s) for s in found.sums]], "mean": [found.mean.tolist()], "scatter": [found.scatter.ravel().tolist()]},
                schema=pa.schema([("n", pa.int64()), ("sums", pa.list_(pa.string())), ("mean", pa.list_(pa.float64())), ("scatter", pa.list_(pa.float64()))]),
            )

    parts = df.select(vector).mapInArrow(partial, "n bigint, sums array<string>, mean array<double>, scatter array<double>")
    unpacked = parts.rdd.map(lambda r: Moments(r["n"], [int(s) for s in r["sums"]], np.array(r["mean"]), np.array(r["scatter"]).reshape(len(r["mean"]), -1)))
    none = Moments(0, [], np.zeros(0), np.zeros((0, 0)))
    total = unpacked.treeAggregate(none, either, either)
    return total if total.n else None


def either(a: Moments, b: Moments) -> Moments:
    return b if not a.n else a if not b.n else a.merge(b)


@dataclass
class Whitening:
    """``n`` and ``sums`` of the fit list, ``components`` (dims x k, unit columns by falling eigenvalue), eigenvalues, shares of all variance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0


def usual_length(df: DataFrame, vector: str) -> int | None:
    """The length that most vectors have (of equally frequent ones the greatest)."""
    first = df.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("k")).count().orderBy(F.desc("count"), F.desc("k")).first()
    return None if first is None else first["k"]


def fit(grid: DataFrame, vector: str = "__x", k: int = 16) -> Whitening | None:
    """Fits on each distinct vector once and checks that what the fit list becomes has the identity as its covariance. None without vectors or variance."""
    distinct = cut(grid.select(vector).distinct())
    m = moments(distinct, vector)
    if m is None:
        return None
    values, vectors = np.linalg.eigh(m.scatter / m.n)
    order = np.argsort(values)[::-1]
    total = float(np.trace(m.scatter / m.n))
    kept = [i for i in order if values[i] > LEAST_SHARE * total][:k]
    if not kept:
        return None
    model = Whitening(m.n, m.sums, vectors[:, kept], values[kept], values[kept] / total)
    seen = moments(project(distinct, model, vector, []).select("whitened"), "whitened")
    model.identity_error = float(np.abs(seen.scatter / seen.n - np.eye(len(kept))).max())
    return model


def project(grid: DataFrame, model: Whitening, vector: str, keep: list[str]) -> DataFrame:
    """Adds ``deviation`` (exact; raises where it leaves 64 bits) and ``whitened``, one value for each component."""
    n, sums, weights = model.n, model.sums, model.components / np.sqrt(model.eigenvalues)
    mean = np.array([float((s - n * OFFSET) / n) for s in sums])

    def make():
        def run(column: pa.Array) -> list[pa.Array]:
            x = matrix(column)
            if not len(x):
                return [pa.array([], pa.int64()), pa.array([], pa.list_(pa.float64()))]
            white = ((x - OFFSET).astype(np.float64) - mean) @ weights
            return [pa.array(deviations(x, n, sums), pa.int64()), pa.array(list(white), pa.list_(pa.float64()))]

        return run

    return scan(grid, [vector], "deviation bigint, whitened array<double>", make, keep=keep)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum of (n*x - S)^2 over dimensions, in 64 bits where all steps fit and in Python integers elsewhere."""
    far = n * max(abs(int(x.min())), abs(int(x.max()))) + max(abs(s) for s in sums)
    if far < 2**62:
        off = n * x - np.array(sums, dtype=np.int64)
        if int(np.abs(off).max()) ** 2 * x.shape[1] < 2**62:
            return (off * off).sum(axis=1).tolist()
    return [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]


def whiten(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", k: int = 16) -> DataFrame:
    """One row for each vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows without a vector, or with entries that are null or not finite, are left out, and so are empty vectors and those of another length than most.
    Repeated vectors count once in the fit and each gets its rows. Directions without variance give no component, so equal vectors, or a single one, or
    an empty table give no rows. A null ``vec_id`` stays null; other columns are ignored.
    """
    grid = df.select(F.col(vec_id).alias("vec_id"), on_grid(vector).alias("__x")).where("__x is not null")
    length = usual_length(grid, "__x")
    if length is not None:
        grid = grid.where(F.size("__x") == length)
    model = None if length is None else fit(grid, "__x", k)
    kind = df.schema[vec_id].dataType.simpleString()
    if model is None:
        return df.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    shares = F.array(*[F.lit(float(s)) for s in model.explained])
    rows = project(grid, model, "__x", ["vec_id"]).select("vec_id", "deviation", F.posexplode("whitened").alias("__i", "whitened"))
    return rows.select(
        "vec_id", (F.col("__i") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("__i")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
