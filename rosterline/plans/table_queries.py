"""The operators bound to the provided tables.

Roles: orders are salary periods (customer = employee, priority = designation, order
date = start, price = salary), customer is the employee master and the leave quota,
events are leave entries and message flags, conversations are messages and documents
give the vocabulary. Every query reads its tables whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as fc
from ..operators import calendar, clean, leave, leave_masks, merge, messages, periods, reports, strikes
from ..schemas import CALENDAR, EMPLOYEE, rung_names
from ..session import scratch_path, tune
from ..sources import digests, files, layers, versions
from ..streaming import messages as message_io
from ..streaming import strike_stream
from . import daily, jobs

# The parameters the queries and their SQL share.
ASOF = dt.datetime(2024, 1, 31)
OVERLAY_DAY = dt.date(2002, 1, 1)
FLAG_VALUE = 40
MID_MONTH = dt.datetime(2024, 1, 16)
BATCH_START = dt.datetime(2024, 1, 29)
UPCOMING_FIRST = dt.date(2024, 1, 10)
UPCOMING_LAST = dt.date(2024, 1, 31)
UPCOMING_PERCENT = 60.0
HOLIDAYS_OF_MONTH = (1, 15, 26)
QUARTER_MONTHS = (1, 4, 7, 10)
MARKED = ("the", "die", "la")
BEST = ["salary", "order_id"]


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- roles -------------------------------------------------------------------------


def period_rows(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "orders").select(
        fc.text_id("o_custkey").alias("emp_id"),
        F.col("o_orderpriority").alias("designation"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.col("o_totalprice").alias("salary"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("delivery"),
    )


def chained(spark: SparkSession, d: str) -> DataFrame:
    return periods.settle(period_rows(spark, d).drop("delivery"), BEST)


def flag_rows(spark: SparkSession, d: str) -> DataFrame:
    return (
        _read(spark, d, "events")
        .filter((F.col("event_type") == "error") & (F.col("value") > FLAG_VALUE))
        .select(fc.text_id("user_id").alias("employee_id"), F.col("ts").alias("start_date"))
    )


def all_counts(spark: SparkSession, d: str) -> DataFrame:
    return strikes.decay(flag_rows(spark, d), ASOF)


def struck_ids(spark: SparkSession, d: str) -> DataFrame:
    return strikes.struck_out(all_counts(spark, d), count="strike_count")


def balances(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "customer").select(
        fc.text_id("c_custkey").alias("employee_id"), F.col("c_acctbal").alias("salary")
    )


def rungs_for(spark: SparkSession, d: str, counts: DataFrame) -> DataFrame:
    return strikes.ladder(counts.join(balances(spark, d), "employee_id"))


def counts_before(spark: SparkSession, d: str, when: dt.datetime) -> DataFrame:
    early = flag_rows(spark, d).filter(F.col("start_date") < fc.moment(when))
    return strikes.decay(early, ASOF)


def leave_rows(spark: SparkSession, d: str) -> DataFrame:
    status = (
        F.when(F.col("event_type") == "error", "CANCELLED")
        .when(F.col("event_type") == "signup", "PENDING")
        .otherwise("ACTIVE")
    )
    return _read(spark, d, "events").select(
        fc.text_id("user_id").alias("emp_id"),
        F.col("ts").cast("date").alias("date"),
        status.alias("status"),
        F.col("ts").alias("ingest_timestamp"),
        "event_id",
    )


def event_holidays(spark: SparkSession, d: str) -> DataFrame:
    """Calendar rows with a time of day and many copies per date."""
    return (
        _read(spark, d, "events")
        .filter(F.dayofmonth("ts").isin(*HOLIDAYS_OF_MONTH))
        .select(F.col("event_type").alias("reason"), F.col("ts").alias("date"))
    )


def order_days(spark: SparkSession, d: str) -> DataFrame:
    return calendar.table_date_range(_read(spark, d, "orders"), "o_orderdate")


def order_holidays(spark: SparkSession, d: str) -> DataFrame:
    when = F.col("o_orderdate")
    first_of_quarter = (F.dayofmonth(when) == 1) & F.month(when).isin(*QUARTER_MONTHS)
    return (
        _read(spark, d, "orders")
        .filter(first_of_quarter)
        .select(F.col("o_orderpriority").alias("reason"), when.alias("date"))
    )


def quota_rows(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "customer").select(
        F.col("c_custkey").alias("emp_id"),
        F.col("c_nationkey").alias("leave_quota"),
        F.lit(2024).alias("year"),
    )


def message_rows(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "conversations").select(
        fc.text_id("conv_id").alias("sender"),
        F.col("role").alias("receiver"),
        F.col("text").alias("message"),
        "turn",
    )


def words_of(df: DataFrame, text: str = "text") -> DataFrame:
    return df.select(F.explode(fc.word_tokens(text, "lower")).alias("word")).distinct()


def marked_words(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.lit(list(MARKED))).alias("word"))


def _doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in rung_names()})


# --- masters and periods -----------------------------------------------------------


def clean_employees(spark, d):
    customer = _read(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return clean.clean_records(customer, ["c_custkey", "c_name", "c_acctbal"], "c_acctbal")


def best_per_key(spark, d):
    rows = period_rows(spark, d).drop("end_date", "delivery")
    return clean.best_per_key(rows, ["emp_id", "start_date"], BEST)


def timeframe_chain(spark, d):
    return chained(spark, d)


def timeframe_chain_fill(spark, d):
    """Finished orders bring their own end date; only the others are filled."""
    given = F.when(F.col("delivery") == "F", F.date_add("start_date", 30))
    rows = period_rows(spark, d).withColumn("end_date", given).drop("delivery")
    return periods.settle(rows, BEST, mode="fill")


def epoch_dates(spark, d):
    """Periods delivered as epoch seconds."""
    day = F.to_timestamp("start_date").cast("bigint").cast("double")
    raw = period_rows(spark, d).withColumns({"start_date": day, "end_date": day + 86400.0 * 30})
    return periods.convert_epochs(raw).select("order_id", "emp_id", "start_date", "end_date")


def _merged(spark, d, touched_only):
    rows = period_rows(spark, d)
    stored = periods.settle(rows.filter(F.col("delivery").isin("F", "P")).drop("delivery"), BEST)
    incoming = rows.filter(F.col("delivery").isin("P", "O")).drop("delivery")
    return periods.merge_periods(stored, incoming, BEST, touched_only=touched_only)


def timeframe_merge(spark, d):
    return _merged(spark, d, touched_only=False)


def timeframe_merge_touched(spark, d):
    return _merged(spark, d, touched_only=True)


def timeframe_merge_struck(spark, d):
    """Deliveries for struck-out employees are refused."""
    rows = period_rows(spark, d)
    stored = periods.settle(rows.filter(F.col("delivery") == "F").drop("delivery"), BEST)
    incoming = rows.filter(F.col("delivery") != "F").drop("delivery")
    return periods.merge_periods(stored, incoming, BEST, struck=struck_ids(spark, d))


def new_periods(spark, d):
    """Delivered periods that are not stored yet, open ends compared null-safely."""
    rows = period_rows(spark, d)
    stored = rows.filter(F.col("delivery").isin("F", "P"))
    keys = ["emp_id", "start_date", "end_date", "salary"]
    return merge.anti_by_key(rows, stored, keys).select("order_id", *keys)


def struck_overlay(spark, d):
    return periods.apply_struck(chained(spark, d), struck_ids(spark, d), OVERLAY_DAY)


def struck_overlay_history(spark, d):
    return periods.apply_struck(
        chained(spark, d), struck_ids(spark, d), OVERLAY_DAY, whole_history=True
    )


def mark_inactive(spark, d):
    return merge.update_where_in(
        chained(spark, d), struck_ids(spark, d), "emp_id", "employee_id", "status", "INACTIVE"
    )


def active_by_group(spark, d):
    return reports.active_by_group(chained(spark, d), run_date=OVERLAY_DAY)


def headcount_upsert(spark, d):
    """Head-counts of the later deliveries merged into those of the first."""
    rows = period_rows(spark, d)

    def count(kind):
        part = rows.filter(F.col("delivery") == kind).drop("delivery")
        return reports.active_by_group(periods.settle(part, BEST))

    return merge.merge_by_key(count("F"), count("O"), ["designation"])


# --- calendar and leave ------------------------------------------------------------


def date_range(spark, d):
    return order_days(spark, d)


def working_days(spark, d):
    return calendar.working_days(order_days(spark, d), order_holidays(spark, d))


def non_working_days(spark, d):
    return calendar.non_working_days(order_days(spark, d), order_holidays(spark, d))


def calendar_load(spark, d):
    rows = _read(spark, d, "events").select(
        F.col("event_type").alias("reason"), F.col("ts").cast("date").alias("date")
    )
    return calendar.load_calendar(rows)


def quota_load(spark, d):
    rows = _read(spark, d, "orders").select(
        F.col("o_custkey").alias("emp_id"),
        F.dayofmonth("o_orderdate").alias("leave_quota"),
        F.year("o_orderdate").alias("year"),
    )
    return leave.load_quota(rows)


def active_ids(spark, d):
    return periods.read_actives(struck_overlay(spark, d)).select("emp_id")


def leave_intake(spark, d):
    """The active employees come from a written table, as in the job: then both sides of
    the semi join come from exchanges and a hot employee can be split."""
    path = scratch_path(spark, "active")
    active_ids(spark, d).write.parquet(path)
    return leave.intake(leave_rows(spark, d), event_holidays(spark, d), spark.read.parquet(path))


def leave_reconcile(spark, d):
    """The vote is per employee and date, so it comes first and leaves one row per date."""
    rows = leave.intake(leave_rows(spark, d), event_holidays(spark, d))
    voted = leave.reconcile(rows, ["ingest_timestamp", "event_id"])
    return voted.join(active_ids(spark, d), "emp_id", "left_semi").select(*voted.columns)


def reconciled_once(spark, d):
    """The reconciled leaves, written for queries that use them twice."""
    path = scratch_path(spark, "reconciled")
    leave_reconcile(spark, d).write.parquet(path)
    return spark.read.parquet(path)


def leave_reconcile_history(spark, d):
    """The first half of the month is the stored state the second half is voted into."""
    rows = leave.intake(leave_rows(spark, d), event_holidays(spark, d))
    order = ["ingest_timestamp", "event_id"]
    day = dt.date(2024, 1, 20)
    stored = leave.reconcile(rows.filter(F.col("ingest_timestamp") < fc.moment(MID_MONTH)), order)
    # Corrections: later entries are about the same weekday one or two weeks before.
    late = rows.filter(F.col("ingest_timestamp") >= fc.moment(MID_MONTH)).withColumn(
        "date", F.when(F.col("date") < day, F.date_sub("date", 7)).otherwise(F.date_sub("date", 14))
    )
    return leave.reconcile(leave.with_history(late, stored), order)


# --- reports -----------------------------------------------------------------------


def _upcoming(spark, d, statuses):
    days = calendar.working_days(
        calendar.date_range(spark, UPCOMING_FIRST, UPCOMING_LAST), event_holidays(spark, d)
    )
    return reports.upcoming_leaves(
        leave_reconcile(spark, d), days, UPCOMING_FIRST, UPCOMING_LAST, UPCOMING_PERCENT,
        statuses=statuses, run_date=UPCOMING_FIRST,
    )


def upcoming_leaves(spark, d):
    return _upcoming(spark, d, None)


def upcoming_leaves_active(spark, d):
    return _upcoming(spark, d, ["ACTIVE"])


def quota_usage(spark, d):
    return reports.quota_usage(leave_reconcile(spark, d), quota_rows(spark, d), 2024, 2)


def _masks(spark, d):
    return leave_masks.day_masks(leave_reconcile(spark, d), ["emp_id", "status"])


def leave_day_masks(spark, d):
    days = leave_masks.days_in([F.col(m) for m in leave_masks.MONTHS])
    return _masks(spark, d).withColumn("days", days)


def upcoming_leaves_masks(spark, d):
    days = calendar.working_days(
        calendar.date_range(spark, UPCOMING_FIRST, UPCOMING_LAST), event_holidays(spark, d)
    )
    return leave_masks.upcoming_leaves(
        _masks(spark, d), days, UPCOMING_FIRST, UPCOMING_LAST, UPCOMING_PERCENT, run_date=UPCOMING_FIRST
    )


def quota_usage_masks(spark, d):
    return leave_masks.quota_usage(_masks(spark, d), quota_rows(spark, d), 2024, 2)


def quota_over(spark, d):
    return reports.over_quota(quota_usage(spark, d))


def _over(spark, d, leaves):
    return reports.over_quota(reports.quota_usage(leaves, quota_rows(spark, d), 2024, 2))


def _alerted_before(spark, d, leaves):
    """Who was over the threshold counting only the entries of the first half."""
    return _over(spark, d, leaves.filter(F.col("ingest_timestamp") < fc.moment(MID_MONTH))).select("emp_id")


def new_alerts(spark, d):
    leaves = reconciled_once(spark, d)
    return reports.new_alerts(_over(spark, d, leaves), _alerted_before(spark, d, leaves))


def alert_history(spark, d):
    leaves = reconciled_once(spark, d)
    return reports.alert_history(_alerted_before(spark, d, leaves), _over(spark, d, leaves))


def alert_lines(spark, d):
    return reports.alert_lines(quota_over(spark, d), UPCOMING_LAST)


# --- strikes -----------------------------------------------------------------------


def strike_counts(spark, d):
    return all_counts(spark, d)


def strike_counts_decayed(spark, d):
    return strikes.decay(flag_rows(spark, d), ASOF, days=10)


def strike_counts_batch(spark, d):
    flags = flag_rows(spark, d)
    cut = fc.moment(BATCH_START)
    return strikes.count_flags(
        flags.filter(F.col("start_date") < cut), flags.filter(F.col("start_date") >= cut), ASOF
    )


def rolling_flags(spark, d):
    errors = (
        _read(spark, d, "events")
        .filter(F.col("event_type") == "error")
        .select(fc.text_id("user_id").alias("employee_id"), F.col("ts").alias("start_date"))
    )
    return strikes.rolling_counts(errors, dt.timedelta(days=7))


def penalty_ladder(spark, d):
    return rungs_for(spark, d, all_counts(spark, d))


def penalty_ladder_keep(spark, d):
    """Rungs set in the first half of the month survive a rise to the current salary."""
    stored = rungs_for(spark, d, counts_before(spark, d, MID_MONTH)).drop("salary")
    pay = periods.read_actives(chained(spark, d)).select(
        F.col("emp_id").alias("employee_id"), "salary"
    )
    table = stored.join(pay, "employee_id").join(all_counts(spark, d), "employee_id")
    return strikes.ladder(table, mode="keep")


def changed_rows(spark, d):
    old = rungs_for(spark, d, counts_before(spark, d, MID_MONTH))
    return merge.changed_rows(old, penalty_ladder(spark, d), ["employee_id"])


def changes_by_digests(spark, d):
    """Two stored versions of the ladder; only buckets whose digests differ are read again."""
    root = scratch_path(spark, "ladder")
    for rows in (rungs_for(spark, d, counts_before(spark, d, MID_MONTH)), penalty_ladder(spark, d)):
        digests.write(rows, root, ["employee_id"], buckets=64)
    return digests.compare(spark, root, ["employee_id"])


def salary_sync(spark, d):
    active = periods.read_actives(chained(spark, d))
    return _doubles(strikes.sync_salaries(active, penalty_ladder(spark, d)))


def strike_upsert(spark, d):
    """Salary-sync rows replace strike rows by employee."""
    table = penalty_ladder(spark, d)
    return merge.merge_by_key(table, salary_sync(spark, d), ["employee_id"], mode="replace")


def struck_out(spark, d):
    return struck_ids(spark, d)


def struck_out_exact(spark, d):
    return strikes.struck_out(all_counts(spark, d), count="strike_count", exact=True)


def merge_by_key(spark, d):
    base = _read(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    supplier = _read(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return merge.merge_by_key(base, supplier, ["id"])


def repeated_keys(spark, d):
    return merge.duplicate_keys(period_rows(spark, d), ["emp_id", "start_date"])


# --- messages ----------------------------------------------------------------------


def flag_messages(spark, d):
    return _flagged(spark, d, inline_marked=True)


def flag_messages_joined(spark, d):
    return _flagged(spark, d, inline_marked=False)


def _flagged(spark, d, inline_marked):
    vocab = words_of(_read(spark, d, "documents"))
    kept = messages.keep_flagged(
        message_rows(spark, d), marked_words(spark), vocab, fold="lower", inline_marked=inline_marked
    )
    return kept.select(F.col("sender").alias("employee_id"), "turn")


def message_tokens(spark, d):
    rows = message_rows(spark, d)
    return rows.select("sender", "turn", F.size(fc.word_tokens("message", "lower")).alias("words"))


def encode_messages(spark, d):
    return messages.encode(message_rows(spark, d))


def decode_messages(spark, d):
    return messages.decode(messages.encode(message_rows(spark, d)))


# --- sources, sinks and streams (they write to the shared folder) --------------------


def csv_round_trip(spark, d):
    """Written with a header, read back by declared schema."""
    path = scratch_path(spark, "customer-csv")
    customer = _read(spark, d, "customer")
    files.write_csv(customer, path, "overwrite")
    return files.read_csv(spark, path, customer.schema)


def csv_text_clean(spark, d):
    """Read as text only, then cleaned with safe casts."""
    path = scratch_path(spark, "customer-text")
    files.write_csv(_read(spark, d, "customer"), path, "overwrite")
    text = files.read_csv(spark, path).select("c_custkey", "c_name", "c_acctbal")
    kept = clean.clean_records(text, ["c_custkey", "c_name", "c_acctbal"], "c_acctbal")
    return kept.select(
        F.col("c_custkey").try_cast("bigint").alias("c_custkey"),
        "c_name",
        F.col("c_acctbal").try_cast("double").alias("c_acctbal"),
    )


def csv_timeframe(spark, d):
    """Text-only periods from CSV, cast safely, filled and written as CSV again."""
    raw, out = scratch_path(spark, "timeframe-raw"), scratch_path(spark, "timeframe-csv")
    seconds = F.to_timestamp("start_date").cast("bigint")
    given = F.when(F.col("delivery") == "F", seconds + 86400 * 30)
    rows = period_rows(spark, d).withColumns({"start_date": seconds, "end_date": given})
    files.write_csv(rows.drop("delivery"), raw, "overwrite")
    typed = files.read_csv(spark, raw).withColumns(
        {
            "start_date": F.col("start_date").try_cast("double"),
            "end_date": F.col("end_date").try_cast("double"),
            "salary": F.col("salary").try_cast("double"),
            "order_id": F.col("order_id").try_cast("bigint"),
        }
    )
    done = periods.settle(periods.convert_epochs(typed), BEST, mode="fill")
    files.write_csv(done, out, "overwrite")
    return files.read_csv(spark, out, done.schema)


def active_partition(spark, d):
    """Stored by status, read back pruned to the open periods."""
    path = scratch_path(spark, "timeframe")
    files.write_parquet(chained(spark, d), path, "overwrite", ["status"], rebalance=True)
    return files.read_active(spark, path)


def partition_overwrite(spark, d):
    """Overwriting one status partition leaves the other one in place."""
    path = scratch_path(spark, "orders")
    rows = period_rows(spark, d).drop("end_date")
    files.write_parquet(rows, path, "overwrite", ["delivery"], rebalance=True)
    raised = rows.filter(F.col("delivery") == "O").withColumn("salary", F.col("salary") * 2)
    files.write_parquet(raised, path, "overwrite", ["delivery"], dynamic=True)
    return spark.read.parquet(path)


def versioned_rewrite(spark, d):
    """A table merged with a delivery and written as the next version of itself."""
    root = scratch_path(spark, "periods")
    rows = period_rows(spark, d)
    first = periods.settle(rows.filter(F.col("delivery").isin("F", "P")).drop("delivery"), BEST)
    versions.write_next(first, root, ["status"], rebalance=True)
    stored = versions.read_latest(spark, root, first.schema)
    late = rows.filter(F.col("delivery").isin("P", "O")).drop("delivery")
    merged = periods.merge_periods(stored, late, BEST)
    versions.write_next(merged, root, ["status"], rebalance=True)
    return versions.read_latest(spark, root, first.schema)


def alert_files(spark, d):
    """Alert texts written by the executors and read back."""
    path = scratch_path(spark, "alerts")
    files.write_alerts(alert_lines(spark, d), path)
    return files.read_alerts(spark, path).select(
        F.col("report_date").cast("string").alias("report_date"),
        F.regexp_extract("value", "^Employee ID: (.*)", 1).alias("emp_id"),
        "value",
    )


def word_list(spark, d):
    """Brand names as JSON array files, read back as a word list."""
    path = scratch_path(spark, "words")
    brand = F.upper("p_brand")
    arrays = _read(spark, d, "part").select(
        F.col("p_brand").alias("list"), F.to_json(F.array(brand)).alias("value")
    )
    arrays.distinct().write.mode("overwrite").partitionBy("list").text(path)
    return files.read_word_list(spark, path)


def ingest_archive(spark, d):
    """CSV files taken in as a one-off stream."""
    customer = _read(spark, d, "customer")
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "taken")
    files.write_csv(customer, raw, "overwrite")

    def sink(df, batch_id):
        files.write_parquet(df, f"{out}/batch={batch_id}", "overwrite")

    files.ingest_once(
        spark, raw, customer.schema, sink, scratch_path(spark, "state"),
        archive=scratch_path(spark, "archive"),
    )
    return spark.read.schema(customer.schema).parquet(f"{out}/batch=*")


def _stream(spark, d, starts):
    """All messages through the strike stream in three micro-batches, in so many starts."""
    root, sent, state = (scratch_path(spark, n) for n in ("strikes", "messages", "state"))
    vocab_path = scratch_path(spark, "vocab")
    rows = message_rows(spark, d)
    words_of(rows.filter(F.col("receiver") != "system"), "message").write.parquet(vocab_path)
    empty = balances(spark, d).select(
        "employee_id", "salary",
        *[F.lit(None).cast("float").alias(c) for c in rung_names()],
        F.lit(0).alias("no_of_strikes"),
    )
    strike_stream.store_salaries(empty, root, MID_MONTH)
    job = strike_stream.StrikeStream(
        root, marked_words(spark), spark.read.parquet(vocab_path), fold="lower", block=2,
        clock=lambda: ASOF,
    )
    part = F.pmod(F.hash("sender"), F.lit(starts))
    for i in range(starts):
        some = messages.encode(rows.filter(part == i)).repartition(-(-3 // starts), "key")
        message_io.write_messages(some, "text", path=sent, mode="append")
        source = message_io.read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, path=sent)
        strike_stream.start(source, job, state, every=None).awaitTermination()
    return _doubles(strike_stream.strike_table(spark, root))


def stream_strikes(spark, d):
    return _stream(spark, d, 1)


def stream_restart(spark, d):
    """The stream stopped after half of the messages and started again on the same state."""
    return _stream(spark, d, 2)


def _period_store(spark, d, most=2_000_000):
    """A layered table of the periods of the first delivery, and how a further one is merged into it."""
    rows = period_rows(spark, d)
    first = periods.settle(rows.filter(F.col("delivery") == "F").drop("delivery"), BEST)
    table = layers.Table(spark, scratch_path(spark, "layers"), first.schema, "emp_id", most=most)
    table.write(lambda base: first)

    def deliver(kind, meanwhile=None):
        fresh = rows.filter(F.col("delivery") == kind).drop("delivery")
        slots, todo = table.slots(fresh), [meanwhile] if meanwhile else []

        def merged(base):
            ids = fresh.select(F.col("emp_id").alias("_id")).distinct()
            stored = table.read(base, slots).join(ids, F.col("emp_id") == F.col("_id"), "left_semi")
            if todo:
                todo.pop()()
            return periods.merge_periods(stored, fresh, BEST)

        table.write(merged, reads=slots)

    return table, deliver


def interleaved_deliveries(spark, d):
    """Two deliveries at once: the second is merged and stored while the first has read and not stored."""
    table, deliver = _period_store(spark, d)
    deliver("P", meanwhile=lambda: deliver("O"))
    return table.read()


def split_store(spark, d):
    """A store whose parts are split as deliveries make them outgrow a size."""
    table, deliver = _period_store(spark, d, most=4000)
    deliver("O")
    deliver("P")
    return table.read()


def period_changes(spark, d):
    """The periods of employees that the last delivery changed, from its layer and not from the whole table."""
    table, deliver = _period_store(spark, d)
    deliver("O")
    since = table.head().number
    deliver("P")
    found = table.changes(since)
    return table.read() if found is None else found


def headcount_by_differences(spark, d):
    """Head-count after three deliveries, from the sums of the first and the changes since."""
    table, deliver = _period_store(spark, d)
    since, parts = table.head().number, reports.headcount_parts(table.read())
    deliver("O")
    deliver("P")
    changed = table.differences(since)
    parts = reports.headcount_parts(table.read()) if changed is None else reports.headcount_change(parts, *changed)
    return parts.select("designation", "active_employees").withColumn("run_date", F.lit("2002-01-01"))


def _places(spark):
    return jobs.Places(scratch_path(spark, "raw"), scratch_path(spark, "store"))


def _deliver_periods(spark, d, at):
    seconds = F.to_timestamp("start_date").cast("bigint").cast("double")
    rows = period_rows(spark, d).select(
        "emp_id", "designation", seconds.alias("start_date"), F.lit(None).cast("double").alias("end_date"), "salary"
    )
    files.write_csv(rows, at.arriving("timeframe"), "append")


def daily_rerun(spark, d):
    """Employees, periods and strike salaries after two runs of one day."""
    at = _places(spark)
    people = _read(spark, d, "customer").select(
        F.col("c_name").alias("name"), (F.col("c_custkey") % 40 + 20).cast("int").alias("age"),
        F.col("c_custkey").alias("emp_id"),
    )
    files.write_csv(people, at.arriving("employee"), "append")
    _deliver_periods(spark, d, at)
    for hour in (7, 9):
        daily.run_day(spark, at, ASOF.replace(hour=hour, tzinfo=dt.timezone.utc))
    known = spark.read.parquet(at.stored("employee")).groupBy(F.col("emp_id").cast("string").alias("emp_id"))
    held = jobs.stored_timeframe(spark, at).groupBy("emp_id").agg(
        F.count("*").alias("n_periods"), F.max(F.when(F.col("status") == "ACTIVE", F.col("salary"))).alias("salary")
    )
    pay = strike_stream.strike_table(spark, at.stored("strikes")).select(
        F.col("employee_id").alias("emp_id"), F.col("salary").cast("double").alias("strike_salary")
    )
    counted = known.agg(F.count("*").alias("n_records"))
    return counted.join(held, "emp_id", "full_outer").join(pay, "emp_id", "full_outer")


def strike_out_store(spark, d):
    """Stored periods closed for struck-out employees on a day without a delivery."""
    at = _places(spark)
    _deliver_periods(spark, d, at)
    jobs.load_timeframe(spark, at, OVERLAY_DAY)
    gone = f"{at.stored('strikes')}/struck_out/block={0:012d}/origin=stream-{0:020d}"
    struck_ids(spark, d).write.parquet(gone)
    jobs.close_struck(spark, at, OVERLAY_DAY)
    return jobs.stored_timeframe(spark, at)


def leave_two_days(spark, d):
    """Two deliveries of leave entries on two days: each entry votes once."""
    at = _places(spark)
    _deliver_periods(spark, d, at)
    jobs.load_timeframe(spark, at, OVERLAY_DAY)
    files.write_csv(event_holidays(spark, d), at.arriving("calendar"), "append", header=False)
    jobs.load_calendar(spark, at)
    rows, cut = leave_rows(spark, d), fc.moment(MID_MONTH)
    # Entries of the second half are about the same weekday one or two weeks before.
    day = F.when(F.col("date") < dt.date(2024, 1, 20), F.date_sub("date", 7)).otherwise(F.date_sub("date", 14))
    deliveries = (
        rows.filter(F.col("ingest_timestamp") < cut),
        rows.filter(F.col("ingest_timestamp") >= cut).withColumn("date", day),
    )
    for i, entries in enumerate(deliveries):
        files.write_csv(entries.select("emp_id", "date", "status"), at.arriving("leave"), "append")
        asof = ASOF + dt.timedelta(days=i)
        jobs.load_leaves(spark, at, asof)
        jobs.load_leaves(spark, at, asof)  # nothing new arrives
    return jobs.stored_leaves(spark, at).select("emp_id", "date", "status")


def alert_files_two_runs(spark, d):
    """Alerts of two runs of one day; the second run is repeated."""
    path = scratch_path(spark, "alerts")
    leaves = reconciled_once(spark, d)
    over, before = _over(spark, d, leaves), _alerted_before(spark, d, leaves)
    first = over.join(before, "emp_id", "left_semi").select(*over.columns)
    fresh = reports.new_alerts(over, first.select("emp_id"))
    for run, people in ((1, first), (2, fresh), (2, fresh)):
        files.write_alerts(reports.alert_lines(people, UPCOMING_LAST), path, run=run)
    return files.read_alerts(spark, path).select(
        F.col("run").cast("int").alias("run"), F.regexp_extract("value", "^Employee ID: (.*)", 1).alias("emp_id"), "value"
    )


def csv_no_header(spark, d):
    """Calendar rows from CSV without a header."""
    path = scratch_path(spark, "calendar-csv")
    rows = _read(spark, d, "events").select(F.col("event_type").alias("reason"), F.col("ts").alias("date"))
    files.write_csv(rows, path, "overwrite", header=False)
    return calendar.load_calendar(files.read_csv(spark, path, CALENDAR, header=False).withColumn("date", F.to_date("date")))


def empty_delivery(spark, d):
    """The employee job on a delivery without rows and on one with all customers."""
    people = _read(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.lit(30).alias("age"), F.col("c_custkey").alias("emp_id")
    )
    results = []
    for name, rows in (("all", people), ("none", people.filter("emp_id < 0"))):
        at = _places(spark)
        files.write_csv(rows, at.arriving("employee"), "append")
        taken = jobs.load_employees(spark, at, UPCOMING_FIRST)
        stored = files.read_or_empty(spark, at.stored("employee"), EMPLOYEE)
        results.append(stored.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("delivery"), F.lit(taken).alias("taken"), "n_rows"))
    return results[0].union(results[1])


def input_files(spark, d):
    """Rows by the file they were read from, one folder per nation."""
    path = scratch_path(spark, "nations")
    customer = _read(spark, d, "customer").select("c_custkey", "c_nationkey")
    customer.hint("rebalance", "c_nationkey").write.option("header", True).partitionBy("c_nationkey").csv(path)
    read = spark.read.option("header", True).csv(path)
    nation = F.regexp_extract("source_file", "c_nationkey=([0-9]+)/", 1).cast("long").alias("c_nationkey")
    rows = files.with_source_file(read.select("*")).groupBy("source_file").agg(F.count("*").alias("n"))
    listed = files.input_files(read).select("source_file")
    return rows.join(listed, "source_file").groupBy(nation).agg(F.sum("n").alias("n_rows"))


QUERIES = [
    clean_employees, best_per_key, timeframe_chain, timeframe_chain_fill, epoch_dates,
    timeframe_merge, timeframe_merge_touched, timeframe_merge_struck, new_periods,
    struck_overlay, struck_overlay_history, mark_inactive, active_by_group, headcount_upsert,
    date_range, working_days, non_working_days, calendar_load, quota_load,
    leave_intake, leave_reconcile, leave_reconcile_history,
    upcoming_leaves, upcoming_leaves_active, quota_usage, quota_over,
    leave_day_masks, upcoming_leaves_masks, quota_usage_masks, new_alerts, alert_history, alert_lines,
    strike_counts, strike_counts_decayed, strike_counts_batch, rolling_flags,
    penalty_ladder, penalty_ladder_keep, changed_rows, changes_by_digests, salary_sync, strike_upsert,
    struck_out, struck_out_exact, merge_by_key, repeated_keys,
    flag_messages, flag_messages_joined, message_tokens, encode_messages, decode_messages,
    csv_round_trip, csv_text_clean, csv_timeframe, active_partition, partition_overwrite, versioned_rewrite,
    alert_files, alert_files_two_runs, word_list, ingest_archive, stream_strikes, stream_restart,
    interleaved_deliveries, split_store, period_changes, headcount_by_differences, daily_rerun, strike_out_store, leave_two_days, csv_no_header, empty_delivery, input_files,
]


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query):
        return lambda spark, d: query(tune(spark), d)

    return {q.__name__: bound(q) for q in QUERIES}
