"""Comparison of versions by digests of their buckets."""

import pytest

from rosterline.sources import digests

SCHEMA = "k string, a string, n double"


@pytest.fixture
def put(spark, tmp_path):
    def write(rows, schema=SCHEMA, buckets=16):
        return digests.write(spark.createDataFrame(rows, schema), str(tmp_path), ["k"], buckets)

    return write


def found(spark, root, **versions):
    return sorted((tuple(r) for r in digests.compare(spark, str(root), ["k"], **versions).collect()), key=repr)


def test_added_changed_removed(spark, tmp_path, put):
    put([("a", "x", 1.0), ("b", None, 2.0), ("c", "z", None), (None, "o", 1.0)])
    assert len(found(spark, tmp_path)) == 4  # without an older version all were added
    put([("a", "x", 1.0), ("b", "y", 2.0), ("d", "z", 4.0), (None, "o", None)])
    assert found(spark, tmp_path) == sorted(
        [("b", "y", 2.0, "changed"), ("c", "z", None, "removed"), ("d", "z", 4.0, "added"), (None, "o", None, "changed")], key=repr
    )
    assert found(spark, tmp_path, old=2, new=1) == sorted(
        [("b", None, 2.0, "changed"), ("c", "z", None, "added"), ("d", "z", 4.0, "removed"), (None, "o", 1.0, "changed")], key=repr
    )


def test_only_differing_buckets_are_read(spark, tmp_path, put):
    rows = [(f"k{i}", "x", float(i)) for i in range(500)]
    put(rows)
    put([("k7", "x", -1.0), *[r for r in rows if r[0] != "k7"]][::-1])
    assert len(digests.differing(spark, str(tmp_path), 1, 2)) == 1
    out = digests.compare(spark, str(tmp_path), ["k"])
    assert len({f.rsplit("/", 2)[1] for f in out.inputFiles()}) == 1
    assert out.collect() == [("k7", "x", -1.0, "changed")]


def test_a_day_without_changes_reads_no_row(spark, tmp_path, put):
    rows = [(f"k{i}", None, 0.0) for i in range(50)]
    put(rows)
    put(rows[::-1])
    out = digests.compare(spark, str(tmp_path), ["k"])
    assert not out.inputFiles() and out.columns == ["k", "a", "n", "change"] and out.count() == 0


def test_digest_tells_where_nulls_are_and_how_often_rows_occur(spark):
    def of(rows):
        return digests.row_digests(spark.createDataFrame(rows, "a string, b string")).first()

    assert of([("x", None)]) != of([(None, "x")])
    assert of([("x", "y"), ("x", "y")]) != of([("x", "y")])
    assert of([("x", "y"), ("u", "v")]) == of([("u", "v"), ("x", "y")])
    assert of([(None, None), (None, None)]) != of([("x", "y"), ("x", "y")])


def test_other_types_or_buckets_are_compared_whole(spark, tmp_path, put):
    put([("a", "x", 1.0), ("b", "y", 2.0)])
    put([("a", "x", 1), ("b", "y", 3)], "k string, a string, n int")
    assert found(spark, tmp_path) == [("b", "y", 3, "changed")]
    put([("a", "x", 1), ("b", "y", 4)], "k string, a string, n int", buckets=3)
    assert found(spark, tmp_path) == [("b", "y", 4, "changed")]


def test_empty_versions(spark, tmp_path, put):
    assert digests.compare(spark, str(tmp_path), ["k"]) is None
    put([])
    assert digests.compare(spark, str(tmp_path), ["k"]) is None
    put([("a", "x", 1.0)])
    assert found(spark, tmp_path) == [("a", "x", 1.0, "added")]
    put([])
    assert found(spark, tmp_path) == [("a", "x", 1.0, "removed")]


def test_retire_keeps_the_newest(spark, tmp_path, put):
    for n in range(4):
        put([("a", "x", float(n))])
    digests.retire(spark, str(tmp_path), keep=2)
    assert found(spark, tmp_path) == [("a", "x", 3.0, "changed")]
    assert sorted(p.name for p in (tmp_path / "rows").iterdir()) == ["version=00000003", "version=00000004"]
    assert put([("a", "x", 9.0)]) == 5
