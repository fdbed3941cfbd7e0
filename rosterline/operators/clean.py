"""Cleaning of master records and the best-row-per-key rule."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import run_stamp


def clean_records(
    df: DataFrame,
    required: Sequence[str] = ("emp_id", "name", "age"),
    positive: str | None = "age",
    keys: Sequence[str] | None = None,
    asof: dt.date | None = None,
) -> DataFrame:
    """Drop rows with a missing required value or a non-positive number, then duplicates.

    Text in the positive column that is not a number counts as missing. With asof,
    the run day is added as string columns year, month and day.
    """
    kept = df.dropna(subset=list(required))
    if positive:
        value = F.col(positive)
        if dict(df.dtypes)[positive] == "string":
            value = value.try_cast("double")
        kept = kept.filter(value > 0)
    kept = kept.dropDuplicates(list(keys or required))
    return kept.withColumns(run_stamp(asof)) if asof else kept


def ranked_row(columns: Sequence[str], order: Sequence[str | Column]) -> Column:
    """The columns as one struct that compares by the order columns first.

    Equal ranks are settled by the remaining columns, so the greatest struct of a
    group is the same on every run. Its fields go by the names in columns.
    """
    rank = [o if isinstance(o, str) else o.alias(f"rank_{i}") for i, o in enumerate(order)]
    return F.struct(*rank, *[c for c in columns if c not in order_names(order)])


def order_names(order: Sequence[str | Column]) -> list[str]:
    return [o for o in order if isinstance(o, str)]


def best_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the greatest by the order columns, nulls lowest.

    An aggregate and not a ranking window: copies of one key are reduced before the
    shuffle, however many rows share it.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    best = F.max(ranked_row(rest, order)).alias("best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"best.{c}") for c in df.columns]
    )
