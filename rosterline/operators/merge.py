"""Keyed merges and comparisons; a null key part matches a null key part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import any_differs, same_keys


def anti_by_key(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of df whose key is not stored yet.

    The stored keys are not made distinct: an anti join needs no such step, and without it
    both sides come from their exchanges, so Spark may split a hot key.
    """
    known = stored.select(*keys)
    return df.alias("n").join(known.alias("s"), same_keys("n", "s", keys), "left_anti")


def merge_by_key(
    base: DataFrame, updates: DataFrame, keys: Sequence[str], mode: str = "coalesce"
) -> DataFrame:
    """Upsert: rows of both sides by key, updates win.

    "coalesce" takes each column from the update unless it is null there; "replace"
    takes the whole row. Columns missing from updates keep the base value. Keys are
    unique on both sides (see duplicate_keys), so the full outer join has no hot key.
    """
    if mode not in ("coalesce", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    new = updates.withColumn("in_updates", F.lit(True)).alias("u")
    joined = base.alias("b").join(new, same_keys("u", "b", keys), "full_outer")
    fresh = F.col("u.in_updates").isNotNull()

    def pick(column: str):
        if column not in updates.columns:
            return F.col(f"b.{column}")
        if column not in base.columns:
            return F.col(f"u.{column}")
        if mode == "coalesce" and column not in keys:
            return F.coalesce(F.col(f"u.{column}"), F.col(f"b.{column}"))
        return F.when(fresh, F.col(f"u.{column}")).otherwise(F.col(f"b.{column}"))

    columns = base.columns + [c for c in updates.columns if c not in base.columns]
    return joined.select(*[pick(c).alias(c) for c in columns])


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of new whose key is in old with another value in any shared column.

    Values are compared in old's types, so a float column and the double it was
    computed from are equal; nulls are compared as values.
    """
    types = {c: t for c, t in old.dtypes if c not in keys and c in new.columns}
    hit = same_keys("n", "o", keys) & any_differs("n", "o", types)
    return new.alias("n").join(old.alias("o"), hit, "inner").select("n.*")


def update_where_in(
    df: DataFrame, ids: DataFrame, key: str, id_column: str, column: str, value
) -> DataFrame:
    """Set one column to a constant in the rows whose key is among ids."""
    marks = ids.select(F.col(id_column).cast("string").alias("listed_id")).distinct()
    return (
        df.join(marks, F.col(key).cast("string") == F.col("listed_id"), "left")
        .withColumn(column, F.when(F.col("listed_id").isNotNull(), F.lit(value)).otherwise(F.col(column)))
        .select(*df.columns)
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; empty for a valid table."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)
