"""A third of all rows on one key: no task may receive a third of the shuffled rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterline.operators import leave, messages, periods, strikes

N = 60_000
PARTS = 16


@pytest.fixture
def spread(spark):
    """Largest share of the rows that one task of the last exchange receives."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", PARTS)
    spark.conf.set("spark.sql.adaptive.enabled", "false")

    def share(df):
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        return max(sizes) / sum(sizes)

    yield share
    for key, value in old.items():
        spark.conf.set(key, value)


def hot(spark):
    who = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 5000))
    return spark.range(N).select(who.alias("emp_id"), "id")


def test_periods(spark, spread):
    data = hot(spark).select(
        "emp_id",
        F.lit("Dev").alias("designation"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 300).cast("int")).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.col("id").cast("double").alias("salary"),
    )
    out = periods.settle(data, ["salary"])
    assert spread(out) < 0.15
    # After the reduction the hot employee has one row per day.
    assert out.filter("emp_id = 'hot'").count() == 100


def test_leave_vote(spark, spread):
    data = hot(spark).select(
        "emp_id",
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 300).cast("int")).alias("date"),
        F.lit("ACTIVE").alias("status"),
        F.col("id").alias("seq"),
    )
    assert spread(leave.reconcile(data, ["seq"])) < 0.15


def test_rolling_counts(spark, spread):
    data = hot(spark).select(
        F.col("emp_id").alias("employee_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("start_date"),
    )
    out = strikes.rolling_counts(data, dt.timedelta(days=3))
    assert spread(out) < 0.15
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The only window over an employee as a whole runs on one row per grain.
    assert "Join" not in plan


def test_strike_counts(spark, spread):
    data = hot(spark).select(
        F.col("emp_id").alias("employee_id"), F.lit(dt.datetime(2024, 1, 1)).alias("start_date")
    )
    out = strikes.count_flags(data, data.limit(10), dt.datetime(2024, 1, 2))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The history is reduced to the senders of the batch first, and counted with partial sums.
    assert "partial_count" in plan and "LeftSemi" in plan
    assert out.filter("employee_id = 'hot'").first()["strike_count"] >= N // 3


@pytest.mark.parametrize("inline_marked", [True, False])
def test_flagging(spark, inline_marked):
    """One word in every text, one text in a third of all rows, nothing broadcast.

    Spark measures bytes, and copies of a text compress well: the senders are long here.
    """
    wanted = {
        "spark.sql.shuffle.partitions": str(PARTS), "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    old = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        text = F.when(F.col("id") % 3 == 0, "the same words").otherwise(F.concat(F.lit("the word"), F.col("id")))
        data = spark.range(N).select(F.sha2(F.col("id").cast("string"), 512).alias("sender"), text.alias("message"))
        words = spark.range(0, N, 2).select(F.concat(F.lit("word"), F.col("id")).alias("word"))
        known = words.union(spark.range(1).select(F.explode(F.array(*map(F.lit, ("the", "same", "words"))))))
        kept = messages.keep_flagged(data, ["the"], known, fold="lower", inline_marked=inline_marked)
        found = kept.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("sender"))
        sizes = [r["n"] for r in found.collect()]
        assert sum(sizes) == N // 3 + N // 3
        # A third of the input is half of what is left; an even share is a sixteenth.
        assert max(sizes) / sum(sizes) < 2 / PARTS
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
