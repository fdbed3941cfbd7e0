import hashlib
import math
import random

import numpy as np
import pytest

from rosterline.llm import centroid_search


def brute(rows, size=64, k=8, rounds=10, seed=3, scale=1024):
    """Plain k-means in Python integers; rows: (id, vector)."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in first]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((square(v, c), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for c in range(len(centroids)):
            group = [v for (_, v), o in zip(kept, own, strict=True) if o == c]
            if group:
                centroids[c] = [sum(x) // len(group) for x in zip(*group, strict=True)]
    done = [(i, *nearest(v)[::-1]) for i, v in kept]
    each = [sum(d for _, c, d in done if c == n) for n in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, each[c], sum(each), names[c]) for i, c, d in done), key=repr)


COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def test_given_vectors(spark, rows):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    given = [(r.vec_id, r.embedding) for r in vectors.collect()]
    assert rows(centroid_search.cluster(vectors), *COLUMNS) == brute(given)


def test_awkward_vectors(spark, rows):
    nan, inf = float("nan"), float("inf")
    given = [
        (1, None), (2, []), (3, [1.0, 2.0, 3.0]), (4, [1.0, nan, 3.0, 4.0]), (5, [1.0, inf, 3.0, 4.0]), (6, [None, 1.0, 1.0, 1.0]),
        (7, [0.0, 0.0, 0.0, 0.0]), (8, [0.5, -0.5, 0.25, -0.001]), (8, [0.5, -0.5, 0.25, -0.001]), (8, [1.5, -0.5, 0.25, 0.0]),
        (None, [0.1, 0.2, 0.3, 0.4]), (9, [-1.0, -1.0, -1.0, -1.0]), (10, [0.5, 0.5, -0.5, 0.25]),
    ]
    clashes = [f"'clash' as `{c}`" for c in ("id", "vector", "cells", "cluster", "distance", "n", "inertia")]
    vectors = spark.createDataFrame(given, "vec_id long, embedding array<double>").selectExpr("*", *clashes)
    for k in (1, 3, 50):
        got = rows(centroid_search.cluster(vectors, size=4, k=k, rounds=3), *COLUMNS)
        assert got == brute(given, size=4, k=k, rounds=3)
    assert centroid_search.cluster(vectors.limit(0), size=4).collect() == []
    assert centroid_search.cluster(vectors, size=5).collect() == []
    large = spark.createDataFrame([(1, [1e300, 0.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in centroid_search.cluster(large, size=2).collect()] == [2]


def test_ties_go_to_the_smaller_number_and_a_cluster_may_stay_empty():
    centroids = np.array([[4, 0], [0, 4], [4, 0], [0, 0], [2, 2]], np.int64)
    known = centroid_search.Centroids(centroids)
    which, square, _ = known.nearest(np.array([[4, 0], [2, 0], [3, 3], [0, 2], [4, 4], [-9, -9]], np.int64))
    assert which.tolist() == [0, 0, 4, 1, 4, 3] and square.tolist() == [0, 4, 2, 4, 8, 162]


@pytest.mark.parametrize("k, size, spread", [(200, 8, 50), (64, 32, 100_000), (500, 4, 3)])
def test_search_is_exact_and_rejects(k, size, spread):
    rng = np.random.default_rng(k)
    # components spread around a mean of each vector's own, so that there is something to reject by
    centroids, vectors = (rng.integers(-spread, spread, (n, 1)) + rng.integers(-spread // 2, spread // 2, (n, size)) for n in (k, 700))
    which, square, computed = centroid_search.Centroids(centroids).nearest(vectors)
    all_ = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert square.tolist() == all_.min(axis=1).tolist() and which.tolist() == all_.argmin(axis=1).tolist()
    assert computed < 0.9 * k * len(vectors)


def test_largest_components_stay_exact():
    most = 2**30 // 64 - 1
    rng = random.Random(1)
    vectors = np.array([[rng.choice((-most, most, 0)) for _ in range(64)] for _ in range(50)], np.int64)
    which, square, _ = centroid_search.Centroids(vectors[:9]).nearest(vectors)
    for v, c, d in zip(vectors.tolist(), which.tolist(), square.tolist(), strict=True):
        each = [sum((a - b) ** 2 for a, b in zip(v, o, strict=True)) for o in vectors[:9].tolist()]
        assert (min(each), each.index(min(each))) == (d, c)
