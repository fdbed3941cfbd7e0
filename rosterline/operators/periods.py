"""Salary periods: chaining, incremental merge and the struck-out overlay."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import epoch_date
from ..schemas import ACTIVE, INACTIVE
from .clean import best_per_key


def convert_epochs(df: DataFrame, columns: Sequence[str] = ("start_date", "end_date")) -> DataFrame:
    """Epoch seconds to dates."""
    return df.withColumns({c: epoch_date(c) for c in columns})


def period_status(end: str = "end_date") -> Column:
    return F.when(F.col(end).isNull(), ACTIVE).otherwise(INACTIVE)


def chain(
    df: DataFrame,
    key: str = "emp_id",
    start: str = "start_date",
    end: str = "end_date",
    status: str = "status",
    mode: str = "always",
) -> DataFrame:
    """End every period where the employee's next one starts; the last stays open.

    mode "always" replaces given end dates, "fill" sets only missing ones. Expects one
    row per (key, start), so with dates an employee has at most one row per calendar
    day and the window groups stay small even for a key that held a third of the input.
    """
    following = F.lead(start).over(Window.partitionBy(key).orderBy(start))
    if mode == "fill":
        following = F.coalesce(F.col(end), following)
    elif mode != "always":
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumn(end, following).withColumn(status, period_status(end))


def settle(
    df: DataFrame,
    order: Sequence[str | Column],
    key: str = "emp_id",
    start: str = "start_date",
    mode: str = "always",
) -> DataFrame:
    """Best row per (key, start), then chain."""
    return chain(best_per_key(df, [key, start], order), key, start, mode=mode)


def merge_periods(
    existing: DataFrame,
    incoming: DataFrame,
    order: Sequence[str | Column],
    struck: DataFrame | None = None,
    struck_key: str = "employee_id",
    key: str = "emp_id",
    start: str = "start_date",
    touched_only: bool = False,
) -> DataFrame:
    """Add incoming rows (dates already converted) to the stored, chained periods.

    Rows of struck-out employees are refused and their stored periods stay as they are.
    Loading the same rows again changes nothing, and a late row splits the period it
    falls into. With touched_only, just the employees in the delivery are recomputed
    and everybody else's rows pass straight through; that pays when the delivery is
    small beside the store.
    """
    columns = existing.columns
    if struck is not None:
        marks = struck.select(F.col(struck_key).cast("string").alias(key))
        incoming = incoming.join(marks, key, "left_anti")
    fresh = incoming.select(*[c for c in columns if c in incoming.columns])
    if touched_only:
        ids = fresh.select(key).distinct().alias("n")
        same = F.col("p." + key).eqNullSafe(F.col("n." + key))
        others = existing.alias("p").join(ids, same, "left_anti")
        existing = existing.alias("p").join(ids, same, "left_semi")
    elif struck is not None:
        others = existing.join(marks, key, "left_semi").select(*columns)
        existing = existing.join(marks, key, "left_anti").select(*columns)
    else:
        others = None
    redone = settle(existing.unionByName(fresh, allowMissingColumns=True), order, key, start)
    redone = redone.select(*columns)
    return redone if others is None else others.unionByName(redone)


def apply_struck(
    df: DataFrame,
    struck: DataFrame,
    asof: dt.date,
    struck_key: str = "employee_id",
    key: str = "emp_id",
    end: str = "end_date",
    status: str = "status",
    whole_history: bool = False,
) -> DataFrame:
    """Close the open periods of struck-out employees on the asof day.

    whole_history also resets the end of their earlier periods to asof.
    """
    marks = struck.select(F.col(struck_key).cast("string").alias("struck_id")).distinct()
    hit = F.col("struck_id").isNotNull()
    closing = hit if whole_history else hit & (F.col(status) == ACTIVE)
    return (
        df.join(marks, F.col(key).cast("string") == F.col("struck_id"), "left")
        .withColumns(
            {
                end: F.when(closing, F.lit(asof)).otherwise(F.col(end)),
                status: F.when(hit & (F.col(status) == ACTIVE), INACTIVE).otherwise(F.col(status)),
            }
        )
        .select(*df.columns)
    )


def read_actives(df: DataFrame, status: str = "status") -> DataFrame:
    """Open periods only; on a table partitioned by status this prunes to one directory."""
    return df.filter(F.col(status) == ACTIVE)
