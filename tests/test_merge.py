"""Keyed merges, comparisons and master-record cleaning."""

import datetime as dt

import pytest

from rosterline.operators import clean, merge


def frame(spark, data, schema="key string, a string, n int"):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def base(spark):
    return frame(spark, [("k1", "x", 1), ("k2", "y", 2), (None, "o", 7)])


@pytest.fixture
def updates(spark):
    return frame(spark, [("k1", None, 9), ("k3", "z", 3), (None, "p", None)])


def test_merge_coalesce(base, updates, rows):
    assert rows(merge.merge_by_key(base, updates, ["key"])) == [
        ("k1", "x", 9), ("k2", "y", 2), ("k3", "z", 3), (None, "p", 7),
    ]


def test_merge_replace(base, updates, rows):
    assert rows(merge.merge_by_key(base, updates, ["key"], mode="replace")) == [
        ("k1", None, 9), ("k2", "y", 2), ("k3", "z", 3), (None, "p", None),
    ]


@pytest.mark.parametrize("mode", ["coalesce", "replace"])
def test_merge_again_changes_nothing(base, updates, rows, mode):
    once = merge.merge_by_key(base, updates, ["key"], mode=mode)
    assert rows(merge.merge_by_key(once, updates, ["key"], mode=mode)) == rows(once)


def test_merge_with_fewer_columns(base, spark, rows):
    part = spark.createDataFrame([("k1", 5), ("k9", 6)], "key string, n int")
    assert rows(merge.merge_by_key(base, part, ["key"])) == [
        ("k1", "x", 5), ("k2", "y", 2), ("k9", None, 6), (None, "o", 7),
    ]


def test_merge_rejects_unknown_mode(base, updates):
    with pytest.raises(ValueError):
        merge.merge_by_key(base, updates, ["key"], mode="other")


def test_anti_by_key_matches_nulls(base, updates, rows):
    assert rows(merge.anti_by_key(updates, base, ["key"]), "key") == [("k3",)]


def test_changed_rows(spark, rows):
    old = spark.createDataFrame(
        [("same", 80.1, None, 1), ("value", 80.1, None, 1), ("null", None, 2.0, 1), ("moved", 1.0, None, 1),
         ("gone", 1.0, 1.0, 1)],
        "id string, a float, b float, n int",
    )
    new = spark.createDataFrame(
        [("same", 80.1, None, 1), ("value", 80.2, None, 1), ("null", 3.0, 2.0, 1), ("moved", None, 1.0, 1),
         ("new", 1.0, 1.0, 1)],
        "id string, a double, b double, n int",
    )
    assert rows(merge.changed_rows(old, new, ["id"]), "id") == [("moved",), ("null",), ("value",)]


def test_update_where_in(base, spark, rows):
    ids = spark.createDataFrame([("k2",), ("k2",), ("k8",)], "employee_id string")
    got = merge.update_where_in(base, ids, "key", "employee_id", "a", "INACTIVE")
    assert rows(got) == [("k1", "x", 1), ("k2", "INACTIVE", 2), (None, "o", 7)]


def test_duplicate_keys(base, rows):
    assert merge.duplicate_keys(base, ["key"]).isEmpty()
    assert rows(merge.duplicate_keys(base.union(base), ["key"])) == [("k1", 2), ("k2", 2), (None, 2)]


def test_clean_records(spark, rows):
    data = spark.createDataFrame(
        [("A", 30, 1), ("A", 30, 1), ("B", 0, 2), ("C", -1, 3), (None, 20, 4), ("D", None, 5), ("E", 20, None)],
        "name string, age int, emp_id bigint",
    )
    assert rows(clean.clean_records(data, asof=dt.date(2024, 3, 7))) == [("A", 30, 1, "2024", "03", "07")]


def test_clean_text_numbers(spark, rows):
    data = spark.createDataFrame(
        [("A", "30", "1"), ("B", "abc", "2"), ("C", "-5", "3")], "name string, age string, emp_id string"
    )
    assert rows(clean.clean_records(data)) == [("A", "30", "1")]
