"""Scalar column expressions; all stay in the JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's dayofweek numbers for Sunday and Saturday, and the word pattern.
WEEKEND = (1, 7)
WORD = r"(?U)\w+"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def moment(value: dt.datetime) -> Column:
    """A timestamp literal; a datetime without a zone is taken as UTC."""
    return F.lit(value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc))


def epoch_date(seconds: str | Column) -> Column:
    """Date of an epoch-seconds number, in the session zone."""
    return F.to_date(F.timestamp_seconds(as_column(seconds)))


def is_weekend(day: str | Column) -> Column:
    return F.dayofweek(as_column(day)).isin(*WEEKEND)


def text_id(value: str | Column) -> Column:
    """The canonical employee id: a string."""
    return as_column(value).cast("string")


def numeric_id(value: str | Column) -> Column:
    """An id as a number for joins with numeric tables; null when it is not one."""
    return as_column(value).cast("string").try_cast("bigint")


def run_stamp(asof: dt.date) -> dict[str, Column]:
    """The run day as zero-padded string partition columns."""
    return {
        "year": F.lit(f"{asof:%Y}"),
        "month": F.lit(f"{asof:%m}"),
        "day": F.lit(f"{asof:%d}"),
    }


def word_tokens(text: str | Column, fold: str = "upper") -> Column:
    """All words of a text, case-folded, Unicode letters included."""
    folded = {"upper": F.upper, "lower": F.lower}[fold](as_column(text))
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))
