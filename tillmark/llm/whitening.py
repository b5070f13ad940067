"""Whitening of embeddings: distributed covariance, eigenvectors by mixed-precision refinement, projection.

Vectors are put on an integer grid, so counts and sums over the corpus are exact whatever the partitioning. The
distinct grid vectors are written once; their sums, then their centred cross products, are added up in tasks and met
in two levels of sums by matrix row, so no task or group holds more than a few hundred partial rows. Only the finished
matrix, whose size is the dimension's, reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.eigen import eigenvectors
from tillmark.session import materialize

# Fixed values of the contract: the grid.
STEPS = 64
ORIGIN = 1_000_000
COMPONENTS = 16

#: Entries beyond this on the grid saturate, so that differences of two always fit a long.
LIMIT = float(2**61)
#: Partial sums of so many tasks meet at first; their sums meet next.
FAN_IN = 256
#: An eigenvalue below this share of the largest one is rounding of a zero.
RANK_SHARE = 1e-12


@dataclass
class Whitening:
    """A fitted transform: what ``transform`` needs, of the size of the dimension whatever the corpus."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows of ``x`` less the mean: an exact difference to the mean's whole part, then its fraction."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        fraction = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - fraction

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of ``(n x - S)²`` of each row, exact; None where a long cannot hold it."""
        bound = (np.abs(self.centred(x)).max(axis=1, initial=0) + 1) * self.n
        small = len(self.sums) * bound**2 < 2**62
        sums = np.array(self.sums, dtype=object)
        if small.all() and self.n * (np.abs(x).max(initial=0) + 1.0) < 2**62 and max(map(abs, self.sums)) < 2**62:
            return ((self.n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
        exact = [int(((self.n * row.astype(object) - sums) ** 2).sum()) for row in x]
        return [d if d < 2**63 else None for d in exact]


def grid_vectors(embeddings: DataFrame, dimension: int | None = None) -> DataFrame:
    """``(vec_id, x)`` of the rows of ``embeddings`` whose vector is whole, ``x`` the vector on the grid.

    Left out are rows whose vector is null, empty, holds null or non-finite entries, or has another length than
    ``dimension``, which is the commonest length of whole vectors (ties: the longest) unless given.
    """
    entries = F.transform("embedding", lambda c: c.cast("double"))
    whole = F.coalesce(F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf")))), F.lit(False))
    good = embeddings.where(whole & (F.size("embedding") > 0)).select("vec_id", entries.alias("entries"))
    if dimension is None:
        lengths = good.groupBy(F.size("entries").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
        dimension = lengths["length"] if lengths else 0
    step = lambda c: F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c * STEPS))) + F.lit(ORIGIN).cast("bigint")
    return good.where(F.size("entries") == dimension).select("vec_id", F.transform("entries", step).alias("x"))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Vectors of an Arrow list column as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _summed(vectors: DataFrame, dimension: int, width: int, values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``vectors`` of a ``width``-column matrix that ``values`` makes of a batch; None without rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = values(matrix(batch.column("x"), dimension))
                total = made if total is None else total + made
        if total is not None:
            task = TaskContext.get().partitionId() % FAN_IN
            yield _packed(np.arange(len(total)), np.full(len(total), task), total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, at = None, None
        for batch in batches:
            made = np.frombuffer(b"".join(batch.column("part").to_pylist()), dtype=np.float64).reshape(-1, width)
            for k, row in enumerate(batch.column("row").to_pylist()):
                at, total = row, made[k].copy() if total is None else total + made[k]
        if total is not None:
            yield _packed(np.array([at]), np.array([0]), total[None])

    kind = "row bigint, task bigint, part binary"
    first = vectors.select("x").mapInArrow(partial, kind).groupBy("row", "task").applyInArrow(add, kind)
    rows = first.groupBy("row").applyInArrow(add, kind).orderBy("row").collect()
    return np.array([np.frombuffer(r["part"], dtype=np.float64) for r in rows])


def _packed(rows: np.ndarray, tasks: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
    packed = pa.array([np.ascontiguousarray(p, dtype=np.float64).tobytes() for p in parts], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(tasks, pa.int64()), packed], ["row", "task", "part"])


def _exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sum per dimension, as two native sums of high and low halves."""
    entries = vectors.select(F.posexplode("x").alias("at", "c")).groupBy("at")
    high, low = F.sum(F.shiftright("c", 32)), F.sum(F.col("c").bitwiseAND(0xFFFFFFFF))
    found = entries.agg(F.count("*").alias("n"), high.alias("high"), low.alias("low")).orderBy("at").collect()
    return (found[0]["n"] if found else 0), [(r["high"] << 32) + r["low"] for r in found]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``vectors`` (a column ``x`` of grid vectors of one length), each distinct vector counted once.

    None without rows. Components whose eigenvalue is zero to rounding are left out, so a single vector has none.
    """
    distinct = materialize(vectors.select("x").distinct(), "vectors")
    n, sums = _exact_sums(distinct)
    if not n:
        return None
    size = len(sums)
    model = Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0)

    def cross(x: np.ndarray) -> np.ndarray:
        rows = model.centred(x)
        return rows.T @ rows

    covariance = _summed(distinct, size, size, cross) / n
    values, columns = eigenvectors(covariance)
    model.trace = float(np.trace(covariance))
    kept = min(components, int((values > RANK_SHARE * max(values[0], 0)).sum()))
    if not kept:
        return model
    model = Whitening(n, sums, values[:kept], columns[:, :kept], model.trace)
    mean = _summed(distinct, size, kept, lambda x: model.project(x).sum(axis=0, keepdims=True))[0] / n

    def whitened_cross(x: np.ndarray) -> np.ndarray:
        rows = model.project(x) - mean
        return rows.T @ rows

    model.identity_error = float(np.abs(_summed(distinct, size, kept, whitened_cross) / n - np.eye(kept)).max())
    return model


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``(vec_id, deviation, whitened)`` of every row of ``vectors``, ``whitened`` one double per component."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), model.dimension)
            deviations = pa.array(model.deviations(x), pa.int64())
            projected = pa.array(list(model.project(x)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviations, projected], ["vec_id", "deviation", "whitened"])

    return vectors.mapInArrow(run, f"vec_id {kind}, deviation bigint, whitened array<double>")


def whiten(embeddings: DataFrame, components: int = COMPONENTS, dimension: int | None = None) -> DataFrame:
    """A row per kept row of ``embeddings`` and component: ``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    Rows are left out as ``grid_vectors`` says. ``vec_id`` may be null or repeat; every row is answered, and repeated
    vectors count once in the fit. Entries whose grid value passes ±2^61 saturate there. A deviation that no long
    holds is null. Components number from 1 by falling eigenvalue; equal eigenvalues give some orthonormal basis of
    their space; those of zero have no rows. Very long vectors cost the square of their length on the driver. Other
    columns are not read, whatever their names. No rows give no rows.
    """
    vectors = grid_vectors(embeddings, dimension)
    model = fit(vectors, components)
    if model is None or not len(model.values):
        model = Whitening(1, [0], np.ones(0), np.zeros((1, 0)), 1.0)
        vectors = vectors.where("false")
    share = F.lit([float(v / model.trace) for v in model.values]) if len(model.values) else F.array().cast("array<double>")
    rows = transform(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col("at")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
