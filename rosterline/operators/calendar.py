"""Holiday calendar and working days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import is_weekend


def load_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Distinct calendar rows with their year."""
    return df.distinct().withColumn("year", F.year(date))


def holiday_dates(calendar: DataFrame, date: str = "date") -> DataFrame:
    """Distinct non-null holiday dates, time of day removed.

    The date type has about 3.7 million values, so this frame has a fixed upper
    size (tens of MB) whatever the size of the calendar; it may be broadcast.
    """
    return calendar.select(F.col(date).cast("date").alias("date")).dropna().distinct()


def date_range(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Every day from first to last, both included."""
    one = spark.range(1)
    return one.select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))


def table_date_range(df: DataFrame, date: str) -> DataFrame:
    """Every day from the earliest to the latest date of a table."""
    day = F.col(date).cast("date")
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return span.select(F.explode(F.sequence("first", "last")).alias("date"))


def non_working_days(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """Weekends among the days, and all holidays."""
    weekends = days.filter(is_weekend("date")).select("date")
    return holiday_dates(calendar).union(weekends).distinct()


def working_days(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """The days that are neither weekend nor holiday."""
    free = F.broadcast(holiday_dates(calendar))
    return days.filter(~is_weekend("date")).join(free, "date", "left_anti")
