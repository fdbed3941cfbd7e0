"""Leave intake, the status vote and the quota load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_weekend, moment
from ..schemas import ACTIVE, CANCELLED
from .calendar import holiday_dates
from .clean import ranked_row


def intake(
    df: DataFrame,
    calendar: DataFrame,
    active: DataFrame | None = None,
    asof: dt.datetime | None = None,
    key: str = "emp_id",
    date: str = "date",
) -> DataFrame:
    """Leave rows on weekdays outside the holiday calendar, of active employees.

    Rows without a date fall out. With asof, ingest date and time are stamped.
    """
    free = F.broadcast(holiday_dates(calendar).withColumnRenamed("date", date))
    kept = df.filter(~is_weekend(date)).join(free, date, "left_anti")
    if active is not None:
        # No distinct here: the skew-join rule splits a hot employee only where both
        # inputs of the join come straight from their shuffles.
        kept = kept.join(active.select(key), key, "left_semi")
    kept = kept.select(*df.columns)
    if asof is None:
        return kept
    return kept.withColumns(
        {"ingest_date": F.lit(f"{asof:%Y-%m-%d}"), "ingest_timestamp": moment(asof)}
    )


def with_history(today: DataFrame, history: DataFrame) -> DataFrame:
    """Stored leaves and today's, without the partition columns of the store."""
    return history.select(*today.columns).unionByName(today)


def reconcile(
    df: DataFrame,
    latest: Sequence[str | Column] = ("ingest_timestamp",),
    key: str = "emp_id",
    date: str = "date",
    status: str = "status",
) -> DataFrame:
    """One row per (employee, date): the status with more votes, CANCELLED on a tie.

    Of the rows with the winning status the latest survives; other statuses have no
    vote, and a group without a row of the winning status disappears. One aggregate
    with a partial step before the shuffle instead of aggregate, join back and rank.
    """
    rest = [c for c in df.columns if c not in (key, date)]

    def votes(which: str) -> Column:
        return F.count_if(F.col(status) == which)

    def newest(which: str) -> Column:
        return F.max(F.when(F.col(status) == which, ranked_row(rest, latest)))

    tally = df.groupBy(key, date).agg(
        votes(CANCELLED).alias("n_cancelled"),
        votes(ACTIVE).alias("n_active"),
        newest(CANCELLED).alias("cancelled"),
        newest(ACTIVE).alias("active"),
    )
    winner = F.when(F.col("n_cancelled") >= F.col("n_active"), F.col("cancelled")).otherwise(
        F.col("active")
    )
    return (
        tally.select(key, date, winner.alias("row"))
        .filter(F.col("row").isNotNull())
        .select(
            *[F.col(c) if c in (key, date) else F.col(f"row.{c}") for c in df.columns],
            F.year(date).alias("year"),
            F.month(date).alias("month"),
        )
    )


def load_quota(df: DataFrame, columns: Sequence[str] = ("emp_id", "leave_quota", "year")) -> DataFrame:
    """Distinct complete quota rows."""
    return df.dropna(subset=list(columns)).dropDuplicates(list(columns))
