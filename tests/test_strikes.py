"""Strike counts, ladder, strike-out, salary sync and rolling counts."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterline.operators import strikes
from rosterline.schemas import FLAGGED, rung_names
from rosterline.schemas import strikes as strike_schema

T = dt.datetime.fromisoformat
RUNGS = (900.00, 810.00, 729.00, 656.10, 590.49, 531.44, 478.30, 430.47, 387.42, 348.68)


def counted(spark, *data):
    return spark.createDataFrame(list(data), "employee_id string, salary double, strike_count int")


def flags(spark, *data):
    return spark.createDataFrame([(e, T(t)) for e, t in data], FLAGGED)


@pytest.mark.parametrize("arithmetic", ["decimal", "double"])
def test_all_rungs(spark, arithmetic):
    row = strikes.ladder(counted(spark, ("e", 1000.0, 10)), arithmetic=arithmetic).first()
    assert tuple(row)[2:] == (*RUNGS, 10)


def test_rungs_above_the_count_are_null(spark, rows):
    got = rows(strikes.ladder(counted(spark, ("a", 1000.0, 3), ("b", 1000.0, 0), ("c", 1000.0, None))))
    assert got[0][2:] == (*RUNGS[:3], *[None] * 7, 3)
    assert got[1][2:] == (*[None] * 10, 0)
    assert got[2][2:] == (*[None] * 10, 0)


def test_count_is_capped(spark):
    row = strikes.ladder(counted(spark, ("e", 1000.0, 11))).first()
    assert tuple(row)[2:] == (*RUNGS, 10)


def test_half_cents_round_up(spark):
    assert strikes.ladder(counted(spark, ("e", 10.05, 1))).first()["strike_1"] == 9.05


def test_keep_leaves_set_rungs(spark):
    data = spark.createDataFrame(
        [("e", 500.0, 900.0, 810.0, *[None] * 8, 2, 3), ("n", 500.0, *[None] * 10, None, 1),
         ("x", 500.0, 900.0, 810.0, *[None] * 8, 2, 1)],
        "employee_id string, salary double, "
        + ", ".join(f"{c} float" for c in rung_names())
        + ", no_of_strikes int, strike_count int",
    )
    got = {r[0]: tuple(r)[2:] for r in strikes.ladder(data, mode="keep").collect()}
    assert got["e"] == (900.0, 810.0, 364.5, *[None] * 7, 3)
    # A missing stored count is a count of 0, so the first rung is set.
    assert got["n"] == (450.0, *[None] * 9, 1)
    # A strike that has expired clears its rung.
    assert got["x"] == (900.0, *[None] * 9, 1)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.decimals(0, 99999, places=2).map(float), st.integers(0, 14)), min_size=1, max_size=20))
def test_rungs_fall_and_stop_at_the_count(spark, data):
    frame = counted(spark, *[(str(i), s, n) for i, (s, n) in enumerate(data)])
    for row in strikes.ladder(frame).collect():
        rungs = [row[c] for c in rung_names()]
        n = row["no_of_strikes"]
        assert n <= 10 and rungs[n:] == [None] * (10 - n)
        assert all(a >= b for a, b in zip([row["salary"], *rungs[:n]], rungs[:n]))


def test_thirty_days_inclusive(spark, rows):
    data = flags(spark, ("e", "2024-01-31T00:00:00"), ("e", "2024-01-30T23:59:00"), ("e", "2024-02-20T00:00:00"))
    assert rows(strikes.decay(data, T("2024-03-01T00:00:00"))) == [("e", 2)]


def test_only_batch_senders_are_counted(spark, rows):
    history = flags(spark, ("a", "2024-02-20T00:00:00"), ("b", "2024-02-20T00:00:00"), ("a", "2024-01-01T00:00:00"))
    batch = flags(spark, ("a", "2024-02-29T00:00:00"), ("c", "2024-02-29T00:00:00"))
    assert rows(strikes.count_flags(history, batch, T("2024-03-01T00:00:00"))) == [("a", 2), ("c", 1)]


def table(spark, *data):
    """(id, salary, count) as strike-table rows."""
    return spark.createDataFrame(
        [(e, s, *[float(round(s * 0.9**i, 2)) if n and i <= n else None for i in range(1, 11)], n) for e, s, n in data],
        strike_schema(),
    )


def test_score_skips_people_at_the_limit(spark, rows):
    stored = table(spark, ("a", 1000.0, 1), ("b", 1000.0, 10), ("c", 1000.0, 11), ("d", 1000.0, 2))
    counts = spark.createDataFrame([("a", 12), ("b", 3), ("c", 3), ("z", 1)], "employee_id string, strike_count int")
    assert rows(strikes.score(stored, counts), "employee_id", "no_of_strikes") == [("a", 10)]


def test_strike_out_counts_jumps_past_the_limit(spark, rows):
    data = table(spark, ("a", 1.0, 9), ("b", 1.0, 10), ("c", 1.0, 11), ("d", 1.0, None))
    assert rows(strikes.struck_out(data)) == [("b",), ("c",)]
    assert rows(strikes.struck_out(data, exact=True)) == [("b",)]


def test_salary_sync(spark, rows):
    active = spark.createDataFrame(
        [("new", 700.0), ("same", 1000.0), ("raise", 2000.0), ("null", None), ("first", 800.0)],
        "emp_id string, salary double",
    )
    stored = table(spark, ("same", 1000.0, 2), ("raise", 1000.0, 2), ("null", 5.0, 1), ("first", 1.0, None), ("left", 1.0, 1))
    got = {r[0]: tuple(r)[1:] for r in strikes.sync_salaries(active, stored).collect()}
    assert got == {
        "new": (700.0, *[None] * 10, None),
        "raise": (2000.0, 1800.0, 1620.0, *[None] * 8, 2),
        "first": (800.0, *[None] * 10, None),
    }


moment = st.integers(0, 40).map(lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * h))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), moment), min_size=1, max_size=25))
def test_rolling_counts_equal_brute_force(spark, data):
    frame = spark.createDataFrame(data, FLAGGED)
    span = dt.timedelta(days=2)
    for grain in ("hour", "day", "month"):
        got = {(r[0], r[1]): (r[2], r[3]) for r in strikes.rolling_counts(frame, span, grain=grain).collect()}
        want = {
            (e, t): (
                data.count((e, t)),
                sum(1 for e2, t2 in data if e2 == e and t - span <= t2 <= t),
            )
            for e, t in data
        }
        assert got == want


def test_hot_employee_is_spread_over_grains(spark):
    """A third of the rows belong to one employee; no window group holds them all."""
    data = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id"))).alias("employee_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("start_date"),
    )
    out = strikes.rolling_counts(data, dt.timedelta(days=1))
    top = out.filter("employee_id = 'hot'").agg(F.max("rolling_flags"), F.count("*")).first()
    assert tuple(top) == (481, 3000)
