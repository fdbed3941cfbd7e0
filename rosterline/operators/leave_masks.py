"""Leave days as bit masks: one row per employee, year and status, one mask per month.

Bit n - 1 of column `m<k>` stands for day n of month k. Masks are built by one aggregate of
fixed-width buffers, so what is shuffled is a row per employee, year and status and not one per
day; repeated days fall together without a `distinct`. Working days are masks too, and counting
the days that two sets share is a bit count of an AND.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ACTIVE
from .reports import against_quota

MONTHS = [f"m{k}" for k in range(1, 13)]


def day_masks(df: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """(keys, year, m1 .. m12): the days of each key; rows without a date are left out."""
    day = F.col(date).cast("date")
    bit = F.call_function("shiftleft", F.lit(1), F.day(day) - 1)
    months = [F.bit_or(F.when(F.month(day) == k, bit).otherwise(0)).alias(m) for k, m in enumerate(MONTHS, 1)]
    return df.filter(day.isNotNull()).groupBy(*keys, F.year(day).alias("year")).agg(*months)


def joined_masks(masks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The days of all rows of a key and year together: of several statuses, or of stored and new masks."""
    return masks.groupBy(*keys, "year").agg(*[F.bit_or(m).alias(m) for m in MONTHS])


def days_in(masks: Sequence[Column]) -> Column:
    """How many days some masks of a row hold."""
    return sum((F.bit_count(m) for m in masks), F.lit(0))


def days_shared(masks: DataFrame, days: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """(keys, days): how many of the given days each key has, keys without any left out.

    The given days are at most one row per year when they are masks, hence safe to broadcast.
    """
    wanted = day_masks(days, [], date).select("year", *[F.col(m).alias(f"wanted_{m}") for m in MONTHS])
    both = joined_masks(masks, keys).join(F.broadcast(wanted), "year")
    shared = days_in([F.col(m).bitwiseAND(F.col(f"wanted_{m}")) for m in MONTHS])
    return both.groupBy(*keys).agg(F.sum(shared).alias("days")).filter("days > 0")


def upcoming_leaves(
    masks: DataFrame,
    days: DataFrame,
    first: dt.date,
    last: dt.date,
    threshold: float = 8.0,
    statuses: Sequence[str] | None = None,
    end_inclusive: bool = False,
    key: str = "emp_id",
    status: str = "status",
    run_date: dt.date | None = None,
) -> DataFrame:
    """What `reports.upcoming_leaves` gives, from masks by key and status.

    days are the working days of the range; the years outside it are filtered before anything moves.
    """
    picked = masks.filter(F.col("year").between(first.year, last.year))
    if statuses is not None:
        picked = picked.filter(F.col(status).isin(*statuses))
    day = F.col("date").cast("date")
    within = days.filter((day >= first) & ((day <= last) if end_inclusive else (day < last)))
    counts = days_shared(picked, within, [key]).withColumnRenamed("days", "upcoming_leaves_count")
    total = days.agg(F.count("*")).scalar()
    out = counts.filter(F.try_divide(F.col("upcoming_leaves_count"), total) * 100 > threshold)
    return out.withColumn("run_date", F.lit(f"{run_date:%Y-%m-%d}")) if run_date else out


def quota_usage(
    masks: DataFrame, quota: DataFrame, year: int, month: int, key: str = "emp_id", status: str = "status"
) -> DataFrame:
    """What `reports.quota_usage` gives for leaves of one row per employee and day, from masks.

    No shuffle but that of the join with the quota: a key has one row of the year and status.
    """
    taken = days_in([F.col(m) for m in MONTHS[: month - 1]]).cast("long")
    active = masks.filter((F.col("year") == year) & (F.col(status) == ACTIVE))
    counted = active.select(key, taken.alias("leaves_taken")).filter("leaves_taken > 0")
    return against_quota(counted, quota, year, key)
