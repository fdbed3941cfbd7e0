"""Leave days as bit masks, against one row per day."""

import datetime as dt

from pyspark.sql import functions as F

from rosterline.operators import calendar, leave_masks, reports

D = dt.date
LEAVES = [
    ("a", D(2023, 12, 29), "ACTIVE"), ("a", D(2024, 1, 2), "ACTIVE"), ("a", D(2024, 1, 31), "INACTIVE"),
    ("a", D(2024, 2, 29), "ACTIVE"), ("b", D(2024, 1, 2), "ACTIVE"), ("b", D(2024, 1, 2), "INACTIVE"),
    ("c", None, "ACTIVE"), (None, D(2024, 12, 31), "ACTIVE"),
]


def leaves(spark):
    return spark.createDataFrame(LEAVES, "emp_id string, date date, status string")


def test_masks_hold_each_day_once(spark):
    rows = leaves(spark)
    masks = leave_masks.day_masks(rows.union(rows), ["emp_id", "status"])
    got = {(r.emp_id, r.year, r.status): r for r in masks.collect()}
    assert len(got) == 6 and got["a", 2024, "ACTIVE"].m2 == 1 << 28 and got["a", 2024, "ACTIVE"].m1 == 2
    assert got["a", 2024, "INACTIVE"].m1 == 1 << 30 and got[None, 2024, "ACTIVE"].m12 == 1 << 30
    counted = masks.select(leave_masks.days_in([F.col(m) for m in leave_masks.MONTHS]).alias("n"))
    assert sum(r.n for r in counted.collect()) == 7
    again = leave_masks.joined_masks(masks.union(masks), ["emp_id", "status"])
    assert sorted(map(repr, again.select(masks.columns).collect())) == sorted(map(repr, masks.select(masks.columns).collect()))


def test_reports_agree_with_rows_per_day(spark):
    rows = leaves(spark).filter("emp_id IS NOT NULL")
    masks = leave_masks.day_masks(rows, ["emp_id", "status"])
    first, last = D(2023, 12, 20), D(2024, 1, 31)
    days = calendar.date_range(spark, first, last)
    for statuses in (None, ["ACTIVE"]):
        for inclusive in (True, False):
            options = dict(threshold=2.0, statuses=statuses, end_inclusive=inclusive, run_date=first)
            want = reports.upcoming_leaves(rows, days, first, last, **options)
            got = leave_masks.upcoming_leaves(masks, days, first, last, **options)
            assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    quota = spark.createDataFrame([("a", "4", 2024), ("b", "0", 2024)], "emp_id string, leave_quota string, year int")
    for month in (1, 2, 3, 13):
        want, got = reports.quota_usage(rows, quota, 2024, month), leave_masks.quota_usage(masks, quota, 2024, month)
        assert got.dtypes == want.dtypes and set(got.collect()) == set(want.collect())


def test_one_row_per_employee_is_shuffled(spark):
    plan = leave_masks.day_masks(leaves(spark), ["emp_id"])._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and plan.count("Exchange") == 1
