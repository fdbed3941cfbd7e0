import math
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from rosterline.llm import mixing


def highest_quotients(weights, seats):
    """Sainte-Laguë seat by seat; ties to the first."""
    won = [0] * len(weights)
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


@pytest.mark.parametrize("weights, seats", [([53, 24, 23], 7), ([5, 5, 5], 4), ([1000, 1, 1, 0], 50), ([3.5], 9), ([1, 2, 3, 4], 1), ([2, 2], 0)])
def test_seats_go_to_the_highest_quotients(spark, weights, seats):
    frame = spark.createDataFrame([(0, i, float(w), seats) for i, w in enumerate(weights)], "g int, i int, w double, seats long")
    got = {r.i: r.quota for r in mixing.sainte_lague(frame, ["g"], "i", "w", "seats").collect()}
    assert [got[i] for i in range(len(weights))] == highest_quotients(weights, seats)


def shared(sizes, weights, growth, most):
    """Targets by sharing the excess again and again."""
    left, target = growth * sum(sizes), [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        level = left / sum(weights[i] for i in free)
        full = {i for i in free if level * weights[i] >= most * sizes[i]}
        if not full:
            for i in free:
                target[i] = level * weights[i]
            break
        for i in full:
            target[i] = most * sizes[i]
            left -= target[i]
        free -= full
    return target


def test_targets(spark):
    sizes = [100, 5, 70, 0, 300, 12, 9]
    frame = spark.createDataFrame([(chr(97 + i) if i < 6 else None, n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {r.place: r.target for r in mixing.targets(frame, (3, 1, 2), 1.5, 2.0).collect()}
    want = shared(sizes, [(3, 1, 2)[i % 3] for i in range(7)], 1.5, 2.0)
    assert all(math.isclose(got[i + 1], want[i], abs_tol=1e-9) for i in range(7))


def test_taken_words_come_near_the_targets(documents):
    rows = mixing.mix(documents, keep=("source",)).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r["keep.source"]] += r.taken
        target[r["keep.source"]] = r.target
        assert 0 <= r.taken <= 2 * r.size
        assert r.taken == r.copies * r.size + sum(c["to"] - c["from"] for c in r.cuts)
    assert all(abs(taken[s] - target[s]) <= max(40, 0.01 * target[s]) for s in target)
    again = {r.doc_id: r.taken for r in mixing.mix(documents).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_texts_hold_the_words_taken(documents):
    got = mixing.mixed_rows(documents)
    assert got.columns == documents.columns
    words = {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    want = {r.doc_id: r.taken for r in mixing.mix(documents).collect() if r.taken}
    assert words == want


def test_many_shards(documents):
    rows = mixing.mix(documents, keep=("source",), shard_scale=1).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r["keep.source"]] += r.taken
        target[r["keep.source"]] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] for s in target)


def test_awkward_rows(awkward):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert {r.source_size for r in rows if r.doc_id in (1, 7)} == {0}
    assert mixing.mixed_rows(awkward).columns == awkward.columns
    mixing.mixed_rows(awkward).collect()
    assert mixing.mix(awkward.limit(0)).count() == 0
    silent = mixing.mix(awkward.filter("doc_id in (1, 2, 3)")).collect()
    assert [(r.target, r.taken) for r in silent] == [(0.0, 0)] * 3


def test_word_count_is_that_of_the_sql(spark):
    text = " a\x0bb\x1cc d\n\ne "
    got = spark.createDataFrame([(text,)], "t string").select(mixing.word_count(F.col("t"))).first()[0]
    assert got == duckdb.execute(r"SELECT len(regexp_extract_all(?, '[^\x20\x09-\x0D]+'))", [text]).fetchone()[0] == 3
