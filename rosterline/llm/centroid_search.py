"""k-means over integer vectors; the nearest centroid by equal-average equal-variance search.

With S the sum of a vector's n components and V^2 = n * (sum of squares) - S^2, two vectors x
and c are apart by at least

    n * d(x, c)^2 >= (Sx - Sc)^2 + (Vx - Vc)^2.

Centroids are sorted by S, that is by component mean. A vector looks at them outward from its own
mean: once (Sx - Sc)^2 alone is beyond n times the best square so far, so is every centroid
further out; a centroid whose deviation is too far off is passed over; for the rest the square is
computed exactly, in integers. Rejections are strict, so equally near centroids are all seen and
the smaller number wins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import picked, settings, small_table, staged

# Vectors searched together: bounds a task's memory whatever the batch size is.
TOGETHER = 4096
# No distance is as large as FAR; bounds from floating point are loosened by these.
FAR = np.iinfo(np.int64).max
LOOSE, ROUNDING = 1e-9, 1e-6


class Centroids:
    """Centroids in the order of their means."""

    def __init__(self, points: np.ndarray):
        sums = points.sum(axis=1)
        self.number = np.lexsort((np.arange(len(points)), sums))
        self.points, self.sums = points[self.number], sums[self.number]
        self.spread = self._spread(self.points, self.sums)

    @staticmethod
    def _spread(points: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return np.sqrt((points.shape[1] * (points**2).sum(axis=1) - sums**2).astype(np.float64))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, squared distance) of each vector, and how many squares were computed."""
        size, k = vectors.shape[1], len(self.sums)
        own = vectors.sum(axis=1)
        spread = self._spread(vectors, own)
        high = np.searchsorted(self.sums, own)
        low = high - 1
        best, which = np.full(len(vectors), FAR), np.full(len(vectors), k)
        going, computed = np.arange(len(vectors)), 0
        while len(going):
            below, above = low[going], high[going]
            down = np.where(below >= 0, own[going] - self.sums[np.maximum(below, 0)], FAR)
            up = np.where(above < k, self.sums[np.minimum(above, k - 1)] - own[going], FAR)
            gap, left = np.minimum(down, up), down <= up
            limit = size * best[going].astype(np.float64) * (1 + LOOSE)
            square = gap.astype(np.float64) ** 2
            open_ = (gap < FAR) & (square <= limit)
            going, at = going[open_], np.where(left, below, above)[open_]
            left, square, limit = left[open_], square[open_], limit[open_]
            low[going] -= left
            high[going] += ~left
            apart = np.maximum(np.abs(spread[going] - self.spread[at]) - ROUNDING, 0)
            near = square + apart**2 <= limit
            look, at = going[near], at[near]
            exact = ((vectors[look] - self.points[at]) ** 2).sum(axis=1)
            computed += len(look)
            number = self.number[at]
            better = (exact < best[look]) | (exact == best[look]) & (number < which[look])
            best[look[better]], which[look[better]] = exact[better], number[better]
        return which, best, computed


def _matrix(column, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _chunks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for low in range(0, len(batch), TOGETHER):
        part = batch.slice(low, TOGETHER)
        yield part, _matrix(part.column("vector"), size)


def integers(vectors: DataFrame, id: str, embedding: str, size: int, scale: int) -> DataFrame:
    """(id, vector): floor(scale * x) of each component of the vectors that take part."""
    cells = F.col(f"`{embedding}`").cast("array<double>")
    rows = picked(vectors, *dict.fromkeys([id, embedding])).select(F.col(f"`{id}`").alias("id"), cells.alias("cells"))
    most = 2**30 // size / scale
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < most)
    rows = rows.filter((F.size("cells") == size) & F.forall("cells", fits))
    return rows.select("id", F.transform("cells", lambda x: F.floor(scale * x).cast("int")).alias("vector"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of `seed:id`, in that order; repeated ids by their components."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return np.array([r["vector"] for r in rows.orderBy(order, "vector").limit(k).collect()], np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every vector to its nearest centroid, every centroid with vectors to their floored mean.

    A task sends one row of sums per centroid, the driver gets k * size sums.
    """
    k, size = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, counts = Centroids(centroids), np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, part in _chunks(batch, size):
                which, _, _ = known.nearest(part)
                order = np.argsort(which, kind="stable")
                present, first = np.unique(which[order], return_index=True)
                total[present] += np.add.reduceat(part[order], first, axis=0)
                counts += np.bincount(which, minlength=k)
        held = np.flatnonzero(counts)
        table = [pa.array(held, pa.int64()), pa.array(counts[held]), pa.array(list(total[held]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(table, ["cluster", "n", "sums"])

    parts = rows.select("vector").mapInArrow(sums, "cluster long, n long, sums array<long>")
    cells = parts.select("cluster", "n", F.posexplode("sums").alias("at", "x"))
    exact = F.sum(F.col("x").cast("decimal(38,0)"))
    after = centroids.copy()
    for r in cells.groupBy("cluster", "at").agg(exact.alias("x"), F.sum("n").alias("n")).collect():
        after[r["cluster"], r["at"]] = int(r["x"]) // r["n"]
    return after


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every row."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Centroids(centroids)
        for batch in batches:
            for part, matrix in _chunks(batch, size):
                which, square, _ = known.nearest(matrix)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(which, pa.int32()), pa.array(square)], ["id", "cluster", "distance"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, cluster int, distance long")


def cluster(
    vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", size: int = 64, k: int = 8, rounds: int = 10,
    seed: int = 3, scale: int = 1024,
) -> DataFrame:
    """A row per vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Components become integers, floor(scale * x); the k first centroids are the vectors with the
    smallest hash of their id; each of `rounds` rounds is one scan; all arithmetic is exact.
    distance is the squared distance to the final centroid, cluster_inertia and inertia its sums,
    centroid_sha256 that of the centroid's components joined by commas.

    Vectors that are null, have another length than `size`, or hold a null or non-finite component
    take no part, nor do those with a component of 2**30 / (scale * size) or more in magnitude,
    whose sums of squares would not fit a long. Fewer vectors than k: as many centroids. A null id
    counts as an empty one for the choice of centroids and stays null; repeated rows are vectors
    of their own; other columns are ignored; no vectors give no rows. The driver and every task
    hold the k centroids, nothing that grows with the rows.
    """
    spark = vectors.sparkSession
    with settings(spark):
        rows = staged(integers(vectors, id, embedding, size, scale), "integers")
        centroids = first_centroids(rows, k, seed)
        if not len(centroids):
            return rows.select(
                F.col("id").alias(id), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
                F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"), F.lit("").alias("centroid_sha256"),
            )
        for _ in range(rounds):
            centroids = moved(rows, centroids)
        done = staged(assigned(rows, centroids), "assigned")
        sums = {r["cluster"]: int(r["x"]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = small_table(
        spark, cluster=pa.array(range(len(centroids)), pa.int32()), centroid_sha256=pa.array(names),
        cluster_inertia=pa.array([sums.get(c, 0) for c in range(len(centroids))], pa.int64()),
    )
    whole = F.lit(sum(sums.values())).cast("long").alias("inertia")
    return done.join(F.broadcast(table), "cluster").select(F.col("id").alias(id), "cluster", "distance", "cluster_inertia", whole, "centroid_sha256")
