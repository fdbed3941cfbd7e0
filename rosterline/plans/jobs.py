"""The jobs: read the inputs of a step, apply its operators, store the result.

Paths come from a Places value; publish, when given, receives (table name, frame,
mode) for every stored result, for example to copy it into a database. It is handed
the stored table, so nothing is computed a second time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .. import schemas
from ..operators import calendar, clean, leave, merge, periods, reports, strikes
from ..sources import commits, files, layers, versions
from ..streaming import strike_stream

Publish = Callable[[str, DataFrame, str], None]


@dataclass(frozen=True)
class Places:
    """Where raw files arrive and where results are kept."""

    raw: str
    store: str

    def arriving(self, name: str) -> str:
        return f"{self.raw}/{name}"

    def stored(self, name: str) -> str:
        return f"{self.store}/{name}"


def _publish(publish: Publish | None, name: str, df: DataFrame, mode: str) -> None:
    if publish:
        publish(name, df, mode)


def _take(
    spark: SparkSession,
    at: Places,
    name: str,
    schema: StructType,
    handle: Callable[[DataFrame], None],
    header: bool = True,
) -> bool:
    """Hand the rows of the files that are new to handle; whether there were any.

    Which files are done is kept with the store and they go to its archive, so a file is
    read once however often the job runs; after a failure in handle it is handed out again.
    """
    if not files.path_exists(spark, at.arriving(name)):
        return False
    taken = []

    def sink(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            handle(df)
            taken.append(batch_id)

    files.ingest_once(
        spark, at.arriving(name), schema, sink, at.stored(f"intake/{name}"), at.stored(f"archive/{name}"), header
    )
    return bool(taken)


def _listed(df: DataFrame, part: Column) -> list[str]:
    """The parts of a table that rows belong to: hash buckets, months or years, so a short list."""
    return [r[0] for r in df.select(part.alias("part")).dropna().distinct().collect()]


def timeframe(spark: SparkSession, at: Places) -> layers.Table:
    """The stored periods; a layer holds all periods of the employees it changes."""
    return layers.Table(spark, at.stored("timeframe"), schemas.TIMEFRAME, "emp_id")


def month_part(date: str = "date") -> Column:
    return F.date_format(F.col(date), "yyyy-MM")


def year_part(year: str = "year") -> Column:
    return F.col(year).cast("string")


LEAVE_STORED = StructType(
    [
        *schemas.LEAVE.fields,
        StructField("year", IntegerType(), True),
        StructField("month", IntegerType(), True),
    ]
)
CALENDAR_STORED = StructType([*schemas.CALENDAR.fields, StructField("year", IntegerType(), True)])
HEADCOUNT = StructType(
    [StructField("designation", StringType(), True), StructField("active_employees", LongType(), True)]
)
HEADCOUNT_SUMS = StructType(
    [
        StructField("designation", StringType(), True),
        StructField("n_rows", LongType(), True),
        StructField("active_employees", LongType(), True),
    ]
)
UPCOMING = StructType(
    [StructField("emp_id", StringType(), True), StructField("upcoming_leaves_count", LongType(), True)]
)
USAGE = StructType(
    [
        StructField("emp_id", StringType(), True),
        StructField("leaves_taken", LongType(), True),
        StructField("leave_quota", IntegerType(), True),
        StructField("leave_percent", DoubleType(), True),
    ]
)


def stored_timeframe(spark: SparkSession, at: Places) -> DataFrame:
    return timeframe(spark, at).read()


def stored_leaves(spark: SparkSession, at: Places) -> DataFrame:
    return versions.read_parts(spark, at.stored("leaves"), LEAVE_STORED)


def stored_calendar(spark: SparkSession, at: Places) -> DataFrame:
    return files.read_or_empty(spark, at.stored("calendar"), CALENDAR_STORED)


def stored_quota(spark: SparkSession, at: Places) -> DataFrame:
    return versions.read_parts(spark, at.stored("quota"), schemas.QUOTA)


def load_employees(spark: SparkSession, at: Places, asof: dt.date, publish: Publish | None = None) -> bool:
    path = at.stored("employee")
    today = f"{path}/year={asof:%Y}/month={asof:%m}/day={asof:%d}"

    def handle(df: DataFrame) -> None:
        # One partition per run day, with what the day has brought so far; it is read
        # from a version of its own, since a partition cannot be overwritten from itself.
        staged = at.stored(f"intake/employee-rows/day={asof:%Y-%m-%d}")
        before = versions.read_latest(spark, staged, schemas.EMPLOYEE)
        rows = clean.clean_records(df, asof=asof)
        names = schemas.EMPLOYEE.fieldNames()
        versions.write_next(before.unionByName(rows.select(*names)).distinct(), staged)
        stored = versions.read_latest(spark, staged, schemas.EMPLOYEE)
        parts = {"year": f"{asof:%Y}", "month": f"{asof:%m}", "day": f"{asof:%d}"}
        stored = stored.withColumns({k: F.lit(v) for k, v in parts.items()})
        files.write_parquet(stored, path, "overwrite", list(parts), dynamic=True)
        out = spark.read.schema(schemas.EMPLOYEE).parquet(today)
        _publish(publish, "employee", out.select("emp_id", "name", "age"), "upsert")

    return _take(spark, at, "employee", schemas.EMPLOYEE, handle)


def _publish_timeframe(table: layers.Table, rows: DataFrame, first: bool, publish: Publish | None) -> None:
    """All periods of the employees that changed, to replace theirs; the whole table at first."""
    out = (table.read() if first else rows).withColumn("emp_id", F.col("emp_id").try_cast("bigint"))
    _publish(publish, "timeframe", out, "overwrite" if first else "replace emp_id")


def load_timeframe(spark: SparkSession, at: Places, asof: dt.date, publish: Publish | None = None) -> bool:
    """Merge delivered periods: the periods of the delivered employees are read, settled and stored as a layer.

    What is read and recomputed are those employees' rows, what is written too; if another writer
    changes one of them meanwhile, the merge is made again.
    """
    table = timeframe(spark, at)

    def handle(df: DataFrame) -> None:
        struck = strike_stream.struck_out_table(spark, at.stored("strikes"))
        marks = struck.select(F.col("employee_id").cast("string").alias("emp_id"))
        fresh = periods.convert_epochs(df).join(marks, "emp_id", "left_anti")
        slots = table.slots(fresh)
        first = not table.head().number

        def merged(base: commits.Commit) -> DataFrame:
            ids = fresh.select(F.col("emp_id").alias("_id")).distinct()
            stored = table.read(base, slots).join(ids, F.col("emp_id").eqNullSafe(F.col("_id")), "left_semi")
            return periods.merge_periods(stored, fresh, order=["salary", "designation", "end_date"])

        rows = table.write(merged, reads=slots)
        _publish_timeframe(table, rows, first, publish)

    return _take(spark, at, "timeframe", schemas.TIMEFRAME_RAW, handle)


def close_struck(spark: SparkSession, at: Places, asof: dt.date, publish: Publish | None = None) -> bool:
    """Close the open periods of struck-out employees, with or without a delivery.

    Only their periods are written; on a day on which nobody is to be closed nothing is.
    """
    table = timeframe(spark, at)
    struck = strike_stream.struck_out_table(spark, at.stored("strikes"))
    slots = table.slots(struck, "employee_id")
    if not slots:
        return True

    def closed(base: commits.Commit) -> DataFrame:
        stored = table.read(base, slots)
        marks = struck.select(F.col("employee_id").cast("string").alias("emp_id"))
        open_ = periods.read_actives(stored).join(marks, "emp_id", "left_semi").select(F.col("emp_id").alias("_id"))
        own = stored.join(open_, F.col("emp_id") == F.col("_id"), "left_semi")
        return periods.apply_struck(own, struck, asof)

    rows = table.write(closed, reads=slots)
    if publish:
        _publish_timeframe(table, rows, False, publish)
    return True


def report_headcount(spark: SparkSession, at: Places, asof: dt.date, publish: Publish | None = None) -> bool:
    """Head-count by designation, kept up by what changed since the last report.

    The sums of the last report are stored with the commit they belong to; only the periods of
    employees changed since are read. All periods are where that commit is no longer known.
    """
    table, sums = timeframe(spark, at), at.stored("headcount-sums")
    head, last = table.head(), versions.latest(spark, sums)
    changed = None if last is None else table.differences(last, head.number)
    if changed is None:
        parts = reports.headcount_parts(table.read(head))
    else:
        parts = reports.headcount_change(versions.read_latest(spark, sums, HEADCOUNT_SUMS), *changed)
    if last != head.number:  # the number of a sum is the commit it belongs to
        versions.write_next(parts.coalesce(1), sums, number=head.number)
        parts = versions.read_latest(spark, sums, HEADCOUNT_SUMS)
    out = parts.select("designation", "active_employees").withColumn("run_date", F.lit(f"{asof:%Y-%m-%d}"))
    path = at.stored("headcount")
    files.write_parquet(out, path, "overwrite", ["run_date"], dynamic=True)
    today = files.read_or_empty(spark, f"{path}/run_date={asof:%Y-%m-%d}", HEADCOUNT)
    _publish(publish, "headcount", today, "overwrite")
    return True


def sync_strike_salaries(
    spark: SparkSession, at: Places, asof: dt.datetime, publish: Publish | None = None
) -> bool:
    """Give the strike table the salaries of open periods that have changed since the last sync.

    Only the changes of the periods are read, where the table still knows them; repeating a sync
    reads the same changes and stores the same rows.
    """
    root, table = at.stored("strikes"), timeframe(spark, at)
    head, since = table.head(), strike_stream.synced(spark, root, asof)
    fresh = None if since is None else table.changes(since, head.number)
    active = periods.read_actives(table.read(head) if fresh is None else fresh).select("emp_id", "salary")
    changed = strike_stream.store_salaries(lambda known: strikes.sync_salaries(active, known), root, asof)
    strike_stream.note_synced(spark, root, asof, since, head.number)
    _publish(publish, "strikes", changed, "upsert")
    return True


def load_quota(spark: SparkSession, at: Places, publish: Publish | None = None) -> bool:
    """Delivered quotas replace the stored ones of the same employee and year."""
    root, keys = at.stored("quota"), ["emp_id", "year"]

    def handle(df: DataFrame) -> None:
        rows = clean.best_per_key(leave.load_quota(df), keys, ["leave_quota"])
        touched = _listed(rows, year_part())
        names = schemas.QUOTA.fieldNames()

        def replaced(stored: DataFrame) -> DataFrame:
            return merge.anti_by_key(stored, rows, keys).select(*names).union(rows.select(*names))

        versions.update_parts(spark, root, schemas.QUOTA, year_part(), touched, replaced)
        _publish(publish, "quota", stored_quota(spark, at), "overwrite")

    return _take(spark, at, "quota", schemas.QUOTA, handle)


def load_calendar(spark: SparkSession, at: Places, publish: Publish | None = None) -> bool:
    path = at.stored("calendar")

    def handle(df: DataFrame) -> None:
        # Rows that are stored already are not appended again.
        rows = merge.anti_by_key(
            calendar.load_calendar(df), stored_calendar(spark, at), schemas.CALENDAR.fieldNames()
        )
        files.write_parquet(rows, path, "append", ["year"])
        _publish(publish, "calendar", stored_calendar(spark, at), "overwrite")

    return _take(spark, at, "calendar", schemas.CALENDAR, handle, header=False)


def load_leaves(spark: SparkSession, at: Places, asof: dt.datetime, publish: Publish | None = None) -> bool:
    """Vote delivered entries into the stored leaves; only their months are read and rewritten."""
    root = at.stored("leaves")

    def handle(df: DataFrame) -> None:
        active = periods.read_actives(stored_timeframe(spark, at))
        today = leave.intake(df, stored_calendar(spark, at), active, asof)
        touched = _listed(today, month_part())

        def decided(stored: DataFrame) -> DataFrame:
            return leave.reconcile(leave.with_history(today, stored), ["ingest_timestamp"])

        versions.update_parts(spark, root, LEAVE_STORED, month_part(), touched, decided)
        _publish(publish, "leaves", stored_leaves(spark, at), "overwrite")

    return _take(spark, at, "leave", schemas.LEAVE_RAW, handle)


def report_upcoming(
    spark: SparkSession,
    at: Places,
    asof: dt.date,
    threshold: float = 8.0,
    publish: Publish | None = None,
) -> bool:
    last = dt.date(asof.year, 12, 31)
    days = calendar.working_days(calendar.date_range(spark, asof, last), stored_calendar(spark, at))
    out = reports.upcoming_leaves(stored_leaves(spark, at), days, asof, last, threshold, run_date=asof)
    path = at.stored("upcoming")
    files.write_parquet(out, path, "overwrite", ["run_date"], dynamic=True)
    today = files.read_or_empty(spark, f"{path}/run_date={asof:%Y-%m-%d}", UPCOMING)
    _publish(publish, "upcoming", today, "overwrite")
    return True


def report_usage(
    spark: SparkSession,
    at: Places,
    asof: dt.date,
    year: int | None = None,
    month: int | None = None,
    threshold: float = 80.0,
    per_employee: bool = False,
    publish: Publish | None = None,
) -> bool:
    """Quota usage of the year before the month, and alerts for newly flagged people.

    By default the months of the year that are over; in January those of the last year.
    """
    if year is None or month is None:
        year, month = (asof.year - 1, 13) if asof.month == 1 else (asof.year, asof.month)
    usage = reports.quota_usage(stored_leaves(spark, at), stored_quota(spark, at), year, month)
    path = at.stored("quota_over")
    versions.write_next(reports.over_quota(usage, threshold), path)
    flagged = versions.read_latest(spark, path, USAGE)
    tracking = at.stored("alerted")
    history = versions.read_latest(spark, tracking, schemas.ALERTED)
    fresh = reports.new_alerts(flagged, history)
    if not fresh.isEmpty():
        # The texts go first, under the number the history will have: a failure between
        # the two writes repeats this run's alerts in the same place.
        run = (versions.latest(spark, tracking) or 0) + 1
        texts = reports.alert_lines(fresh, asof)
        files.write_alerts(texts, at.stored("alerts"), per_employee=per_employee, run=run)
        versions.write_next(reports.alert_history(history, fresh), tracking, number=run)
    _publish(publish, "quota_over", flagged, "overwrite")
    return True


def retire(spark: SparkSession, at: Places, keep: int = 2) -> None:
    """Remove versions and blocks that newer ones have replaced; what is in use stays.

    For a time at which no job runs: a job that has begun may read what was newest then.
    """
    for name in ("quota_over", "alerted", "headcount-sums"):
        versions.retire_versions(spark, at.stored(name), keep)
    timeframe(spark, at).retire(keep)
    for name in ("leaves", "quota"):
        versions.retire_parts(spark, at.stored(name))
    rows = at.stored("intake/employee-rows")
    days = sorted(n for n in files.child_names(spark, rows) if n.startswith("day="))
    for name in days[: -max(1, keep)]:  # an earlier day's rows stand in the employee table
        files.remove(spark, f"{rows}/{name}")
    for name in days:
        versions.retire_versions(spark, f"{rows}/{name}", 1)
    strike_stream.retire(spark, at.stored("strikes"), keep)
