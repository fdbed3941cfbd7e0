"""Nearest neighbours by adaptive dimension scan within the probed lists of an inverted file.

Largest inner products are nearest neighbours once every vector x gets one more component,
sqrt(M - |x|^2) with M the largest square, and every query a zero. Vectors are rotated by a
random orthogonal matrix, so the first d of D components estimate a distance: d / D of its
square on average. Candidates are scanned in blocks of components; after each block those are
abandoned whose estimate is beyond the bound of a test at the query's threshold, the distance
of its k-th nearest so far. Those left at the end are scored exactly on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import picked, settings, small_table, staged

# Documented bounds of what is fitted: sampled vectors, which also give each query its first
# threshold; lists whatever the input; and the sampled vectors that count as found.
SAMPLE, MOST_LISTS, SEEDS = 8192, 4096, 512
# Vectors to a list on average, and to the blocks that tasks scan; queries scanned together.
LIST_SIZE, BLOCK, TOGETHER = 1000, 2048, 512
# Components looked at before each test.
COLUMNS = 16


@dataclass(frozen=True)
class Index:
    """What is fitted on the sample; `sizes` counts the vectors of each list over all rows."""

    centroids: np.ndarray
    rotation: np.ndarray
    sample: np.ndarray
    largest: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.largest - (vectors**2).sum(axis=1), 0)
        return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1) @ self.rotation

    def asked(self, queries: np.ndarray) -> np.ndarray:
        return np.concatenate([queries, np.zeros((len(queries), 1))], axis=1) @ self.rotation


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T, 0)


def fit(sample: np.ndarray, largest: float, rows: int, seed: int = 7, rounds: int = 10) -> Index:
    """Centroids by k-means on the lifted, rotated sample."""
    rng = np.random.default_rng(seed)
    size = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((size, size)))[0]
    index = Index(np.zeros((0, size)), rotation, np.zeros((0, size)), largest)
    points = index.lifted(sample)
    lists = min(MOST_LISTS, len(points), max(1, round(rows / LIST_SIZE)))
    centroids = points[rng.choice(len(points), lists, replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([_squares(points[low : low + TOGETHER], centroids).argmin(axis=1) for low in range(0, len(points), TOGETHER)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        counts = np.bincount(own, minlength=lists)
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return Index(centroids, rotation, points, largest)


def _matrix(column, size: int) -> np.ndarray:
    """A list column of `size` numbers per row as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most TOGETHER rows: bounds the tables of distances to the sample and the centroids."""
    for batch in batches:
        for low in range(0, len(batch), TOGETHER):
            yield batch.slice(low, TOGETHER)


def scan(index: Index, block: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int, epsilon: float):
    """For each query the rows of the block that may be among its k nearest by the tests.

    bounds: a squared distance that k other vectors are known not to exceed. The first k
    candidates left at the end lower it further; ties at the bound are kept.
    """
    points, asked = index.lifted(block), index.asked(queries)
    size = points.shape[1]
    start = _squares(points[:, :COLUMNS], asked[:, :COLUMNS]).T
    for q in range(len(queries)):
        part, left, seen = start[q], np.arange(len(points)), min(COLUMNS, size)
        bound = bounds[q] * (1 + 1e-9) + 1e-9
        while True:
            slack = 1.0 if seen == size else (1 + epsilon / np.sqrt(seen)) ** 2 * seen / size
            going = part <= bound * slack
            left, part = left[going], part[going]
            if seen == size or not len(left):
                break
            after = min(size, seen + COLUMNS)
            part = part + ((points[left, seen:after] - asked[q, seen:after]) ** 2).sum(axis=1)
            seen = after
        if len(left) > k:
            last = np.partition(part, k)[k]  # one more than k: the query itself may be among them
            left = left[part <= last * (1 + 1e-9) + 1e-9]
        yield q, left


def search(
    vectors: DataFrame, asked: Column, id: str = "vec_id", embedding: str = "embedding", k: int = 20,
    share: float = 0.8, epsilon: float = 2.1,
) -> DataFrame:
    """(query_id, rank, id, score): the k found with the largest inner product, ties to smaller ids.

    Queries are the rows for which `asked` holds, candidates all rows but the query's own. A
    query probes its nearest lists until they hold `share` of all vectors and more than k of
    them. Its threshold is the distance of the k-th nearest sampled vector: what is farther is
    none of its k nearest. The nearest of SEEDS sampled vectors count as found, so there are k
    results even where the nearest lie in other lists or a test errs. Vectors that are alike need a small share, unordered ones most. The index is fitted
    on at most SAMPLE vectors and holds every row. A list is scanned in blocks of about BLOCK
    rows, each with groups of at most TOGETHER queries, so neither a large list nor many equal
    vectors meet in one task. Scores are inner products of the original vectors in double
    precision.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor
    do those of another length than most have (the shortest of the most frequent). Null ids
    take part as candidates, after others with the same score, and never ask. Repeated rows are
    candidates of each other. Fewer candidates than k: all of them. Other columns are ignored;
    an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = picked(vectors, *dict.fromkeys([id, embedding])).select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("vector"),
        F.coalesce(asked & F.col(f"`{id}`").isNotNull(), F.lit(False)).alias("asks"),
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.filter("size(vector) > 0").filter(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    kind = rows.schema["id"].dataType.simpleString()
    result = f"query_row long, query_id {kind}, row long, id {kind}, score double"
    with settings(spark):
        sizes = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
        if sizes is None:
            return _ranked(spark.createDataFrame([], result), id, k)
        size, total = sizes["n"], sizes["rows"]
        rows = staged(rows.filter(F.size("vector") == size).withColumn("row", F.monotonically_increasing_id()), "vectors")
        square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
        place = F.shiftrightunsigned(F.xxhash64("row", "vector"), 33)
        low = int(min(1.0, 1.3 * SAMPLE / total + 100 / total) * (2**31 - 1))
        largest = rows.agg(F.max(square)).first()[0]
        chosen = rows.filter(place <= low).orderBy(place, "row").limit(SAMPLE).select("vector", "row", "id").collect()
        sample = np.array([r["vector"] for r in chosen])
        index = spark.sparkContext.broadcast(fit(sample, largest, total))
        seeds, seed_rows = sample[:SEEDS], np.array([r["row"] for r in chosen[:SEEDS]])
        seed_ids = pa.array([r["id"] for r in chosen[:SEEDS]])

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                points = index.value.lifted(_matrix(batch.column("vector"), size))
                own = _squares(points, index.value.centroids).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int64())], [*batch.schema.names, "list"])

        held = rows.mapInArrow(listed, f"id {kind}, vector array<double>, asks boolean, row long, list long")
        held = staged(held, "index")
        counts = {r["list"]: r["n"] for r in held.groupBy("list").agg(F.count("*").alias("n")).collect()}
        full = np.array([counts.get(i, 0) for i in range(len(index.value.centroids))])
        many = small_table(spark, list=pa.array(list(counts), pa.int64()), parts=pa.array([-(-int(n) // BLOCK) for n in counts.values()], pa.int64()))
        needed = min(total, max(share * total, k + 1))

        def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                asked_for = index.value.asked(_matrix(batch.column("vector"), size))
                near = _squares(asked_for, index.value.centroids).argsort(axis=1, kind="stable")
                before = np.cumsum(full[near], axis=1) - full[near]
                row, nth = np.nonzero((before < needed) & (full[near] > 0))
                known = _squares(asked_for, index.value.sample)
                bound = np.partition(known, k, axis=1)[:, k] if known.shape[1] > k else np.full(len(known), np.inf)
                at = pa.array(row)
                kept = [batch.column(c).take(at) for c in ("row", "id", "vector")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(bound[row]), pa.array(near[row, nth], pa.int64())], ["row", "id", "vector", "bound", "list"]
                )

        def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                wanted, asking = _matrix(batch.column("vector"), size), batch.column("row").to_numpy()
                near = _squares(index.value.asked(wanted), index.value.sample[:SEEDS]).argsort(axis=1, kind="stable")[:, : k + 1]
                who, nth = np.nonzero(seed_rows[near] != asking[:, None])
                which = near[who, nth]
                score = (seeds[which] * wanted[who]).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(who)), batch.column("id").take(pa.array(who)),
                     pa.array(seed_rows[which]), seed_ids.cast(batch.column("id").type).take(pa.array(which)), pa.array(score)],
                    ["query_row", "query_id", "row", "id", "score"],
                )

        queries = held.filter("asks").select("row", "id", "vector")
        groups = max(1, -(-queries.count() // TOGETHER))
        probes = queries.mapInArrow(probing, f"row long, id {kind}, vector array<double>, bound double, list long")
        probes = probes.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
        probes = probes.groupBy("list", "group").agg(F.collect_list(F.struct("row", "id", "vector", "bound")).alias("queries"))
        parted = held.join(F.broadcast(many), "list").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
        blocks = parted.groupBy("list", "part").agg(F.collect_list(F.struct("row", "id", "vector")).alias("block"))
        probes = probes.join(F.broadcast(many), "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

        def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    block, queries = batch.column("block")[i].values, batch.column("queries")[i].values
                    own, vectors_of = block.field("row").to_numpy(), _matrix(block.field("vector"), size)
                    asking, wanted = queries.field("row").to_numpy(), _matrix(queries.field("vector"), size)
                    bounds = queries.field("bound").to_numpy()
                    who, which, score = [], [], []
                    for q, left in scan(index.value, vectors_of, wanted, bounds, k, epsilon):
                        left = left[own[left] != asking[q]]
                        who.append(np.full(len(left), q))
                        which.append(left)
                        score.append((vectors_of[left] * wanted[q]).sum(axis=1))
                    who, which = pa.array(np.concatenate(who)), pa.array(np.concatenate(which))
                    yield pa.RecordBatch.from_arrays(
                        [queries.field("row").take(who), queries.field("id").take(who), block.field("row").take(which),
                         block.field("id").take(which), pa.array(np.concatenate(score))],
                        ["query_row", "query_id", "row", "id", "score"],
                    )

        found = blocks.join(probes, ["list", "part"]).select("block", "queries").mapInArrow(scanned, result)
        found = found.union(queries.mapInArrow(seeded, result))
    return _ranked(found, id, k)


def _ranked(found: DataFrame, id: str, k: int) -> DataFrame:
    """The k best of each query; a row found twice counts once."""
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    single = found.withColumn("again", F.coalesce(F.lag("row").over(order) == F.col("row"), F.lit(False))).filter("NOT again")
    ranked = single.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id), "score")
