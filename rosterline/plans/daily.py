"""The daily run: every job in order, monthly and yearly parts only on their day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from . import jobs
from .jobs import Places, Publish


def monthly_due(asof: dt.date) -> bool:
    return asof.day == 1


def yearly_due(asof: dt.date) -> bool:
    return asof.month == 1 and asof.day == 1


def run_day(
    spark: SparkSession, at: Places, asof: dt.datetime, publish: Publish | None = None
) -> dict[str, str]:
    """Run the jobs of a day; returns "done", "no input" or "not due" per job.

    The leave job reads the active employees, so it comes after the timeframe job.
    """
    day = asof.date()
    outcome: dict[str, str] = {}

    def run(name: str, due: bool, job) -> None:
        if not due:
            outcome[name] = "not due"
        else:
            outcome[name] = "done" if job() else "no input"

    yearly, monthly = yearly_due(day), monthly_due(day)
    run("employees", True, lambda: jobs.load_employees(spark, at, day, publish))
    run("timeframe", True, lambda: jobs.load_timeframe(spark, at, day, publish))
    run("struck", True, lambda: jobs.close_struck(spark, at, day, publish))
    run("headcount", True, lambda: jobs.report_headcount(spark, at, day, publish))
    run("salaries", True, lambda: jobs.sync_strike_salaries(spark, at, asof, publish))
    run("quota", yearly, lambda: jobs.load_quota(spark, at, publish))
    run("calendar", yearly, lambda: jobs.load_calendar(spark, at, publish))
    run("leaves", True, lambda: jobs.load_leaves(spark, at, asof, publish))
    run("upcoming", True, lambda: jobs.report_upcoming(spark, at, day, publish=publish))
    run("usage", monthly, lambda: jobs.report_usage(spark, at, day, publish=publish))
    return outcome
