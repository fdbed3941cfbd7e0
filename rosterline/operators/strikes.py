"""Strike counts, the penalty ladder, strike-out and the salary sync."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import moment
from ..functions.pay import rung
from ..schemas import FLAG_DAYS, MAX_STRIKES, STRIKE_FACTOR, rung_names, strikes


def recent(flags: DataFrame, asof: dt.datetime, days: int = FLAG_DAYS, ts: str = "start_date") -> DataFrame:
    """Flags no older than the given days at asof; exactly that old still counts."""
    return flags.filter(F.col(ts) >= moment(asof - dt.timedelta(days=days)))


def decay(
    flags: DataFrame,
    asof: dt.datetime,
    days: int = FLAG_DAYS,
    key: str = "employee_id",
    ts: str = "start_date",
) -> DataFrame:
    """Everybody's strike count at asof, so that old strikes expire without a new flag."""
    return recent(flags, asof, days, ts).groupBy(key).agg(F.count("*").alias("strike_count"))


def count_flags(
    history: DataFrame,
    batch: DataFrame,
    asof: dt.datetime,
    days: int = FLAG_DAYS,
    key: str = "employee_id",
    ts: str = "start_date",
) -> DataFrame:
    """Strike counts of the employees in the batch, over their history and the batch.

    The history is reduced to the senders of the batch before anything is counted, so the
    aggregate sees their rows only; neither an id list nor a collected key is needed, and a
    hot sender is combined map-side.
    """
    senders = batch.select(F.col(key).alias("sender"))
    mine = history.select(key, ts).join(senders, F.col(key).eqNullSafe(F.col("sender")), "left_semi")
    pooled = mine.withColumn("arrived", F.lit(False)).unionByName(
        batch.select(key, ts, F.lit(True).alias("arrived"))
    )
    return (
        recent(pooled, asof, days, ts)
        .groupBy(key)
        .agg(F.count("*").alias("strike_count"), F.bool_or("arrived").alias("arrived"))
        .filter("arrived")
        .drop("arrived")
    )


def rolling_counts(
    flags: DataFrame,
    frame: dt.timedelta,
    key: str = "employee_id",
    ts: str = "start_date",
    grain: str = "hour",
) -> DataFrame:
    """For every (employee, time): the flags in the frame that ends there, both ends included.

    The count is a difference of two running totals: up to the time, and up to just
    before the frame starts. Running totals are summed inside (employee, grain) groups
    and completed with the totals of the earlier grains, so an employee who owns a
    large share of all rows is spread over as many tasks as there are grains.
    """
    seen = flags.filter(F.col(ts).isNotNull()).groupBy(key, ts).agg(F.count("*").alias("n"))
    point = F.struct(F.col(ts).alias("at"), F.lit(1).alias("kind"), "n")
    # A probe sorts before the rows of its own instant: those belong to the frame.
    probe = F.struct(
        (F.col(ts) - F.lit(frame)).alias("at"),
        F.lit(0).alias("kind"),
        F.lit(0).cast("bigint").alias("n"),
    )
    cells = (
        seen.select(key, F.col(ts).alias("owner"), F.explode(F.array(point, probe)).alias("row"))
        .select(key, "owner", "row.*")
        .withColumn("cell", F.date_trunc(grain, "at"))
    )
    before = Window.partitionBy(key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # The total of the earlier cells enters each cell as its first row.
    opening = (
        cells.groupBy(key, "cell")
        .agg(F.sum("n").alias("n"))
        .withColumn("n", F.sum("n").over(before))
        .filter(F.col("n").isNotNull())
        .withColumns({"at": F.lit(None), "kind": F.lit(-1), "owner": F.lit(None)})
    )
    inside = (
        Window.partitionBy(key, "cell")
        .orderBy(F.col("at").asc_nulls_first(), "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = cells.unionByName(opening).withColumn("total", F.sum("n").over(inside))
    return (
        running.filter(F.col("kind") >= 0)
        .groupBy(key, F.col("owner").alias(ts))
        .agg(
            F.max(F.when(F.col("kind") == 1, F.col("total"))).alias("upto"),
            F.max(F.when(F.col("kind") == 0, F.col("total"))).alias("expired"),
            F.max("n").alias("flags"),
        )
        .select(key, ts, "flags", (F.col("upto") - F.col("expired")).alias("rolling_flags"))
    )


def at_limit(n: int = MAX_STRIKES, count: str = "no_of_strikes", exact: bool = False) -> Column:
    """Struck out: the count has reached n (exact: equals n)."""
    value = F.coalesce(F.col(count), F.lit(0))
    return (value == n) if exact else (value >= n)


def ladder(
    df: DataFrame,
    salary: str = "salary",
    count: str = "strike_count",
    n: int = MAX_STRIKES,
    factor: str = STRIKE_FACTOR,
    mode: str = "recompute",
    stored: str = "no_of_strikes",
    arithmetic: str = "decimal",
    keep: Sequence[str] = ("employee_id", "salary"),
    rung_type: str = "double",
) -> DataFrame:
    """Rungs 1 to the count hold the reduced salaries, the others are null.

    "recompute" derives every rung from the salary; "keep" leaves the rungs that are
    already set, fills the new ones and clears those above the count. The count is
    capped at n. One projection, whatever n is.
    """
    if mode not in ("recompute", "keep"):
        raise ValueError(f"unknown mode {mode!r}")
    reached = f"CAST(least(coalesce(`{count}`, 0), {n}) AS INT)"
    steps = []
    for i, name in enumerate(rung_names(n), start=1):
        value = rung(f"`{salary}`", i, factor, arithmetic)
        if mode == "keep":
            value = f"CASE WHEN coalesce(`{stored}`, 0) < {i} THEN {value} ELSE {name} END"
        steps.append(f"CASE WHEN {reached} >= {i} THEN CAST({value} AS {rung_type}) END AS {name}")
    return df.selectExpr(*keep, *steps, f"{reached} AS no_of_strikes")


def score(
    table: DataFrame,
    counts: DataFrame,
    n: int = MAX_STRIKES,
    factor: str = STRIKE_FACTOR,
    mode: str = "recompute",
    exact: bool = False,
    arithmetic: str = "decimal",
) -> DataFrame:
    """New strike rows for the counted employees who are in the table and not struck out."""
    open_rows = table.filter(~at_limit(n, exact=exact))
    joined = open_rows.join(counts.select("employee_id", "strike_count"), "employee_id", "inner")
    return ladder(joined, n=n, factor=factor, mode=mode, arithmetic=arithmetic, rung_type="float")


def struck_out(
    df: DataFrame,
    n: int = MAX_STRIKES,
    count: str = "no_of_strikes",
    key: str = "employee_id",
    exact: bool = False,
) -> DataFrame:
    """Ids of the employees who have reached the limit."""
    return df.filter(at_limit(n, count, exact)).select(key)


def sync_salaries(
    active: DataFrame,
    table: DataFrame,
    key: str = "emp_id",
    n: int = MAX_STRIKES,
    factor: str = STRIKE_FACTOR,
    arithmetic: str = "decimal",
) -> DataFrame:
    """Rows to upsert into the strike table from the active salaries.

    Employees missing from it get a row without strikes; where the salary differs the
    rungs are recomputed for the stored count. A null salary on either side is no
    difference. One left join serves both cases.
    """
    pay = active.select(F.col(key).cast("string").alias("employee_id"), "salary")
    old = table.select(
        F.col("employee_id").alias("known_id"), F.col("salary").alias("old_salary"), "no_of_strikes"
    )
    joined = pay.join(old, F.col("employee_id") == F.col("known_id"), "left")
    due = joined.filter(F.col("known_id").isNull() | (F.col("salary") != F.col("old_salary")))
    rungs = ladder(
        due, count="no_of_strikes", n=n, factor=factor, arithmetic=arithmetic,
        keep=("employee_id", "salary", "known_id", "no_of_strikes AS stored"),
        rung_type="float",
    )
    # A new row has no count yet, as opposed to a count of 0.
    return rungs.select(
        "employee_id", "salary", *rung_names(n),
        F.when(F.col("known_id").isNotNull(), F.col("stored")).cast("int").alias("no_of_strikes"),
    )


def empty_table(spark, n: int = MAX_STRIKES) -> DataFrame:
    return spark.createDataFrame([], strikes(n))
