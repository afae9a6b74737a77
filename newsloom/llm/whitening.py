"""Whitening of vectors by shifted CholeskyQR (operator 11).

Entries become integers, so the sums of all rows are exact. The centred rows are never
multiplied by their transpose for an eigenvalue problem, which would square their
condition number. Instead they are orthogonalised: a distributed pass adds up the Gram
matrix of the rows, its Cholesky factor R divides them by a triangular solve inside the
tasks of the next pass, and so on. The first Gram matrix is shifted, so that its factor
exists however dependent the columns are; the passes end when the Gram matrix is the
identity to ``TOLERANCE``, or after ``PASSES``. The product of all factors is the R of the
centred rows, its singular values and right vectors are those of the rows, and give the
components: directions by falling variance, each divided by its deviation.

Only matrices of dimension x dimension pass between tasks and the driver. Every task adds
up its rows first, and the sums of some tasks at a time are added until few are left.

Rows are left out if their vector is null, holds a null or an entry that is not finite, or
has another length than most (of equally frequent lengths the longer counts); so are
vectors with an entry of ``LARGEST`` or more in magnitude, which have no exact integer
here. A null id is an id like any other, and repeated rows count and return each. A
component without variance, to the precision of the numbers, has no whitened values and
is not returned: equal vectors, a single row and an empty table give no rows. A deviation
above 64 bits is null. Components of equal variance come in any order. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import added_up, landed

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
LARGEST = float(1 << 40)
PASSES, TOLERANCE = 6, 1e-12
#: Entries in a block of rows.
ENTRIES = 1 << 18
#: A direction with a smaller deviation than so much of the largest has none.
FLAT = 1e-12
UNIT = 2.0 ** -53


def usable(vector: Column) -> Column:
    """Whether a vector is there and has only entries of an exact integer; NaN is above all numbers."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST, F.lit(False))), F.lit(False))


def blocks(vectors: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """(ids, x, n, sums, largest): blocks of rows as integers with their sums, and the number of dimensions."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dims = common["d"] if common else 0
    kind = rows.schema["id"].dataType.simpleString()
    height = max(1, min(4096, ENTRIES // max(dims, 1)))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), height):
                part = batch.slice(at, height)
                values = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                x = np.floor(values * SCALE).astype(np.int64) + OFFSET
                ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column("id"))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([x.tobytes()], pa.binary()), pa.array([len(part)], pa.int64()),
                    pa.array([x.sum(axis=0)], pa.list_(pa.int64())), pa.array([np.abs(x).max()], pa.int64())], ["ids", "x", "n", "sums", "largest"])

    made = rows.where((F.size("v") == dims) & (F.size("v") > 0)).mapInArrow(
        of_batches, f"ids array<{kind}>, x binary, n long, sums array<long>, largest long")
    return landed(made, "vectors"), dims


def totals(made: DataFrame) -> tuple[int, list[int], int]:
    """Number of rows, exact sum of each dimension and the largest magnitude."""
    few = made.agg(F.sum("n").alias("n"), F.max("largest").alias("largest")).first()
    each = made.select(F.posexplode("sums").alias("k", "s")).groupBy("k").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    return few["n"] or 0, [int(r["s"]) for r in sorted(each)], few["largest"] or 0


class Centre:
    """The rows of a block around the mean, as exact multiples of 1 / n."""

    def __init__(self, n: int, sums: list[int], largest: int):
        self.n, self.dims = n, len(sums)
        self.narrow = 2 * n * largest < 1 << 62
        self.sums = np.array(sums, np.int64 if self.narrow else object)

    def scaled(self, x: bytes) -> np.ndarray:
        """n * x - S of each entry."""
        rows = np.frombuffer(x, np.int64).reshape(-1, self.dims)
        return (rows if self.narrow else rows.astype(object)) * self.n - self.sums

    def rows(self, x: bytes) -> np.ndarray:
        return (self.scaled(x) / self.n).astype(np.float64)

    def deviations(self, x: bytes) -> list[int | None]:
        """The exact sum of squares of each row of ``scaled``."""
        y = self.scaled(x)
        if self.narrow and (y.astype(np.float64) ** 2).sum(axis=1).max(initial=0) < 1 << 62:
            return (y * y).sum(axis=1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in y.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Q with Q @ factor = rows, for an upper triangular factor."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def added(made: DataFrame, work: Callable[[bytes], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all blocks of the matrix that ``work`` makes of a block."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for x in batch.column("x"):
                total += work(x.as_py())
        yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]})

    parts = made.select("x").mapInArrow(of_batches, "m binary").select(F.spark_partition_id().cast("long").alias("part"), "m")
    return added_up(landed(parts, "sums"), "<f8", shape[0] * shape[1]).reshape(shape)


def factored(made: DataFrame, centre: Centre) -> np.ndarray:
    """The R of the centred rows."""
    d, n = centre.dims, centre.n
    factors: list[np.ndarray] = []
    whole = np.eye(d)
    for k in range(PASSES):
        def gram(x: bytes) -> np.ndarray:
            q = centre.rows(x)
            for factor in factors:
                q = solved(q, factor)
            return q.T @ q

        g = added(made, gram, (d, d))
        if not np.trace(g) > 0:
            return np.zeros((d, d))
        if k and np.abs(g - np.eye(d)).max() < TOLERANCE:
            break
        shift = 11 * (n * d + d * (d + 1)) * UNIT * np.trace(g)
        try:
            # The shift is for the condition of the rows themselves; what a pass has left is near the identity.
            upper = np.linalg.cholesky(g + (min(shift, 1e-4 * np.trace(g)) if not k else 0) * np.eye(d)).T
        except np.linalg.LinAlgError:
            upper = np.linalg.cholesky(g + min(shift, 1e-8) * np.eye(d)).T
        factors.append(np.ascontiguousarray(upper))
        whole = upper @ whole
    return whole


def components(factor: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions as columns, each divided by its deviation, and the share of the variance of each."""
    _, sigma, rows = np.linalg.svd(factor)
    kept = sigma > FLAT * max(sigma.max(initial=0), 1e-300)
    sigma, rows = sigma[kept], rows[kept]
    # Either sign would do; the largest entry is positive.
    rows = rows * np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)])[:, None]
    return (rows / sigma[:, None] * np.sqrt(n)).T[:, :most], (sigma ** 2 / (sigma ** 2).sum())[:most]


def whitened(vectors: DataFrame, most: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component."""
    made, dims = blocks(vectors, vec_id, vector)
    n, sums, largest = totals(made)
    centre = Centre(n, sums, largest)
    turn, share = components(factored(made, centre), n, most) if n else (np.zeros((dims, 0)), np.zeros(0))
    width = turn.shape[1]

    def moments(x: bytes) -> np.ndarray:
        """The sums of squares and products of whitened rows, and below them the sums."""
        w = centre.rows(x) @ turn
        return np.vstack([w.T @ w, w.sum(axis=0)])

    error = 0.0
    if width:
        sums_of = added(made, moments, (width + 1, width)) / n
        error = float(np.abs(sums_of[:-1] - np.outer(sums_of[-1], sums_of[-1]) - np.eye(width)).max())
    kind = vectors.schema[vec_id].dataType.simpleString()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch) if width else 0):
                ids, x = batch.column("ids").slice(k, 1).flatten(), batch.column("x")[k].as_py()
                w = centre.rows(x) @ turn
                m = len(w)
                took = pa.array(np.repeat(np.arange(m), width))
                yield pa.RecordBatch.from_arrays([
                    ids.take(took), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), m)), pa.array(np.full(m * width, n)),
                    pa.array(centre.deviations(x), pa.int64()).take(took), pa.array(w.ravel()), pa.array(np.tile(share, m)),
                    pa.array(np.full(m * width, error))], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return made.select("ids", "x").mapInArrow(
        of_batches, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
