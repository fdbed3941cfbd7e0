"""Head-count, upcoming-leave and quota-usage reports, and alerts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.columns import numeric_id
from ..schemas import ACTIVE
from .merge import anti_by_key

# The text of an alert.
ALERT_TEXT = (
    "Employee ID: %s\nLeave Taken: %d\nLeave Quota: %d\nUsage: %.2f%%\nReport Date: %s\n"
)


def active_by_group(
    periods: DataFrame,
    group: str = "designation",
    key: str = "emp_id",
    status: str = "status",
    run_date: dt.date | None = None,
) -> DataFrame:
    """Active employees for every group that ever occurs, zero where there are none.

    One aggregate: groups come from all rows, the count from active ones. Rows without
    a group form a group of their own whose count is 0, since nobody is matched to it.
    """
    counted = F.when((F.col(status) == ACTIVE) & F.col(group).isNotNull(), F.col(key))
    out = periods.groupBy(group).agg(F.count(counted).alias("active_employees"))
    return out.withColumn("run_date", F.lit(f"{run_date:%Y-%m-%d}")) if run_date else out


def headcount_parts(
    periods: DataFrame, group: str = "designation", key: str = "emp_id", status: str = "status"
) -> DataFrame:
    """Rows and active employees of every group: what `headcount_change` keeps up and `active_by_group` shows."""
    counted = F.when((F.col(status) == ACTIVE) & F.col(group).isNotNull(), F.col(key))
    return periods.groupBy(group).agg(F.count("*").alias("n_rows"), F.count(counted).alias("active_employees"))


def headcount_change(
    parts: DataFrame, before: DataFrame, after: DataFrame, group: str = "designation", key: str = "emp_id", status: str = "status"
) -> DataFrame:
    """The parts after some employees' rows have become others; groups without rows fall out.

    before and after hold all rows of those employees, then and now, and nobody else's.
    """
    less = headcount_parts(before, group, key, status).select(group, (-F.col("n_rows")).alias("n_rows"), (-F.col("active_employees")).alias("active_employees"))
    summed = parts.unionByName(less).unionByName(headcount_parts(after, group, key, status)).groupBy(group)
    out = summed.agg(F.sum("n_rows").alias("n_rows"), F.sum("active_employees").alias("active_employees"))
    return out.filter("n_rows > 0")


def upcoming_leaves(
    leaves: DataFrame,
    days: DataFrame,
    first: dt.date,
    last: dt.date,
    threshold: float = 8.0,
    statuses: Sequence[str] | None = None,
    end_inclusive: bool = False,
    key: str = "emp_id",
    date: str = "date",
    status: str = "status",
    run_date: dt.date | None = None,
) -> DataFrame:
    """Employees whose leave takes more than threshold percent of the working days.

    days are the working days of the range, at most one row per calendar day, hence
    safe to broadcast. The leave on the last day counts only with end_inclusive;
    all statuses count unless some are named.
    """
    day = F.col(date).cast("date")
    picked = leaves.filter((day >= first) & ((day <= last) if end_inclusive else (day < last)))
    if statuses is not None:
        picked = picked.filter(F.col(status).isin(*statuses))
    picked = picked.select(key, day.alias("date")).distinct()
    total = days.agg(F.count("*")).scalar()
    counts = (
        picked.join(F.broadcast(days.select("date").distinct()), "date", "inner")
        .groupBy(key)
        .agg(F.count("date").alias("upcoming_leaves_count"))
    )
    percent = F.try_divide(F.col("upcoming_leaves_count"), total) * 100
    out = counts.filter(percent > threshold)
    return out.withColumn("run_date", F.lit(f"{run_date:%Y-%m-%d}")) if run_date else out


def quota_usage(
    leaves: DataFrame,
    quota: DataFrame,
    year: int,
    month: int,
    key: str = "emp_id",
    date: str = "date",
    status: str = "status",
) -> DataFrame:
    """Active leave days of the year before the month (13: all of it), against its quota.

    The percent is null where the quota is missing or 0. If the leave table has year
    and month columns they are filtered as well, so its partitions are pruned. Ids are
    compared as text where the quota's are text, so an id need not be a number; where they
    are numbers the leave's ids are read as such.
    """
    day = F.col(date).cast("date")
    end = dt.date(year + 1, 1, 1) if month > 12 else dt.date(year, month, 1)
    wanted = (F.col(status) == ACTIVE) & (day >= dt.date(year, 1, 1)) & (day < end)
    if {"year", "month"} <= set(leaves.columns):
        wanted = (F.col("year") == year) & (F.col("month") < month) & wanted
    taken = leaves.filter(wanted).groupBy(key).agg(F.count("*").alias("leaves_taken"))
    return against_quota(taken, quota, year, key)


def against_quota(taken: DataFrame, quota: DataFrame, year: int, key: str = "emp_id") -> DataFrame:
    """Days taken (key, leaves_taken) beside the quota of the year, and the percent (see `quota_usage`)."""
    ident = (lambda c: F.col(c)) if isinstance(quota.schema[key].dataType, StringType) else numeric_id
    limits = quota.filter(F.col("year") == year).select(
        ident(key).alias("quota_id"), F.col("leave_quota").cast("int").alias("leave_quota")
    )
    percent = F.round(F.try_divide(F.col("leaves_taken"), F.col("leave_quota")) * 100, 2)
    return taken.withColumn("quota_id", ident(key)).join(limits, "quota_id", "left").select(
        key, "leaves_taken", "leave_quota", percent.alias("leave_percent")
    )


def over_quota(usage: DataFrame, threshold: float = 80.0) -> DataFrame:
    """Usage rows above the threshold; unknown percentages fall out."""
    return usage.filter(F.col("leave_percent") > threshold)


def new_alerts(flagged: DataFrame, history: DataFrame, key: str = "emp_id") -> DataFrame:
    """Flagged employees who have not been alerted before; a null employee is one, too."""
    return anti_by_key(flagged, history, [key])


def alert_history(history: DataFrame, alerts: DataFrame, key: str = "emp_id") -> DataFrame:
    """Everybody alerted so far, each once."""
    return history.select(key).unionByName(alerts.select(key)).distinct()


def alert_lines(alerts: DataFrame, run_date: dt.date, key: str = "emp_id") -> DataFrame:
    """Report date, employee and the alert text."""
    day = F.lit(f"{run_date:%Y-%m-%d}")
    text = F.format_string(
        ALERT_TEXT, F.col(key).cast("string"), "leaves_taken", "leave_quota", "leave_percent", day
    )
    return alerts.select(day.alias("report_date"), key, text.alias("value"))
