"""The daily run over several days."""

import datetime as dt

import pytest

from rosterline.plans import daily, jobs
from rosterline.streaming import strike_stream as ss

D = dt.date.fromisoformat


@pytest.mark.parametrize(
    "day, monthly, yearly",
    [("2024-01-01", True, True), ("2024-03-01", True, False), ("2024-03-02", False, False)],
)
def test_gates(day, monthly, yearly):
    assert (daily.monthly_due(D(day)), daily.yearly_due(D(day))) == (monthly, yearly)


def put(at, name, text):
    from pathlib import Path

    folder = Path(at.raw) / name
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "rows.csv").write_text(text)


def day_of(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def test_three_days(spark, tmp_path, rows):
    at = jobs.Places(str(tmp_path / "raw"), str(tmp_path / "store"))
    published = []

    def publish(name, df, mode):
        published.append((name, mode, df.count()))

    put(at, "employee", "name,age,emp_id\nAnn,30,1\nAnn,30,1\nBob,-1,2\n")
    put(at, "timeframe", "emp_id,designation,start_date,end_date,salary\n"
        "1,Dev,1672531200,,1000\n1,Lead,1701388800,,1500\n2,QA,1672531200,,900\n")
    put(at, "quota", "emp_id,leave_quota,year\n1,2,2024\n1,2,2024\n2,,2024\n2,20,2024\n")
    put(at, "calendar", "New Year,2024-01-01 00:00:00\nNew Year,2024-01-01 00:00:00\n")
    put(at, "leave", "emp_id,date,status\n1,2024-01-02,ACTIVE\n1,2024-01-03,ACTIVE\n1,2024-01-01,ACTIVE\n"
        "9,2024-01-02,ACTIVE\n2,2024-01-02,ACTIVE\n")
    done = daily.run_day(spark, at, day_of("2024-01-01T07:00:00"), publish)
    assert set(done.values()) == {"done"}
    assert rows(jobs.stored_timeframe(spark, at), "emp_id", "designation", "status") == [
        ("1", "Dev", "INACTIVE"), ("1", "Lead", "ACTIVE"), ("2", "QA", "ACTIVE"),
    ]
    assert rows(jobs.stored_leaves(spark, at), "emp_id", "date") == [
        ("1", D("2024-01-02")), ("1", D("2024-01-03")), ("2", D("2024-01-02")),
    ]
    assert rows(jobs.stored_quota(spark, at)) == [(1, 2, 2024), (2, 20, 2024)]
    assert rows(ss.strike_table(spark, at.stored("strikes")), "employee_id", "salary") == [("1", 1500.0), ("2", 900.0)]
    assert ("employee", "upsert", 1) in published and ("timeframe", "overwrite", 3) in published

    # The same day again: nothing is doubled.
    daily.run_day(spark, at, day_of("2024-01-01T09:00:00"))
    assert spark.read.parquet(at.stored("employee")).count() == 1
    assert jobs.stored_quota(spark, at).count() == 2
    assert jobs.stored_calendar(spark, at).count() == 1
    assert jobs.stored_timeframe(spark, at).count() == 3
    assert jobs.stored_leaves(spark, at).count() == 3
    assert rows(ss.strike_table(spark, at.stored("strikes")), "employee_id", "salary") == [("1", 1500.0), ("2", 900.0)]

    # Employee 1 is struck out in between; on 1 February the monthly report is due.
    struck = spark.createDataFrame([("1",)], "employee_id string")
    struck.write.parquet(f"{at.stored('strikes')}/struck_out/block=000000000000/origin=stream-0")
    done = daily.run_day(spark, at, day_of("2024-02-01T07:00:00"))
    assert done["quota"] == done["calendar"] == "not due" and done["usage"] == "done"
    got = jobs.stored_timeframe(spark, at).filter("designation = 'Lead'")
    assert rows(got, "end_date", "status") == [(D("2024-02-01"), "INACTIVE")]
    alerts = f"{at.stored('alerts')}/report_date=2024-02-01"
    assert "Leave Taken: 2" in spark.read.text(alerts, wholetext=True).first()[0]
    first = spark.read.parquet(at.stored("headcount"))
    assert rows(first.filter("run_date = '2024-02-01'"), "designation", "active_employees") == [
        ("Dev", 0), ("Lead", 0), ("QA", 1),
    ]
    assert first.select("run_date").distinct().count() == 2

    # A month later nobody is alerted a second time, and the end date has not moved.
    daily.run_day(spark, at, day_of("2024-03-01T07:00:00"))
    assert spark.read.text(at.stored("alerts")).select("report_date").distinct().count() == 1
    assert rows(jobs.stored_timeframe(spark, at).filter("designation = 'Lead'"), "end_date") == [(D("2024-02-01"),)]


def test_no_input(spark, tmp_path):
    at = jobs.Places(str(tmp_path / "raw"), str(tmp_path / "store"))
    done = daily.run_day(spark, at, day_of("2024-03-02T07:00:00"))
    assert done["employees"] == done["timeframe"] == done["leaves"] == "no input"
    assert done["headcount"] == "done" and done["usage"] == "not due"


def parts_of(at, name):
    from pathlib import Path

    return {p.relative_to(at.stored(name)) for p in Path(at.stored(name)).rglob("*.parquet") if name == "timeframe" or "part=" in str(p)}


def put_more(at, name, file, text):
    from pathlib import Path

    folder = Path(at.raw) / name
    folder.mkdir(parents=True, exist_ok=True)
    (folder / file).write_text(text)


def test_only_touched_parts_are_rewritten(spark, tmp_path, rows):
    at = jobs.Places(str(tmp_path / "raw"), str(tmp_path / "store"))
    head = "emp_id,designation,start_date,end_date,salary\n"
    put_more(at, "timeframe", "a.csv", head + "".join(f"{i},Dev,1672531200,,{1000 + i}\n" for i in range(40)))
    put_more(at, "leave", "a.csv", "emp_id,date,status\n1,2024-01-02,ACTIVE\n1,2024-01-02,CANCELLED\n2,2024-02-06,ACTIVE\n")
    daily.run_day(spark, at, day_of("2024-03-04T07:00:00"))
    assert rows(jobs.stored_leaves(spark, at), "emp_id", "status") == [("1", "CANCELLED"), ("2", "ACTIVE")]
    before = {n: parts_of(at, n) for n in ("timeframe", "leaves")}
    first = jobs.timeframe(spark, at).head()
    put_more(at, "timeframe", "b.csv", head + "7,Lead,1701388800,,5000\n")
    put_more(at, "leave", "b.csv", "emp_id,date,status\n1,2024-01-02,ACTIVE\n1,2024-01-02,ACTIVE\n")
    daily.run_day(spark, at, day_of("2024-03-05T07:00:00"))
    after = {n: parts_of(at, n) for n in before}
    assert all(before[n] <= after[n] for n in before)
    assert [x["rows"] for x in jobs.timeframe(spark, at).head().state["layers"]] == [2]  # the periods of one employee
    assert first.state["bases"] == jobs.timeframe(spark, at).head().state["bases"]
    assert {str(p).split("/")[1] for p in after["leaves"] - before["leaves"]} == {"part=2024-01"}
    # Both files' votes: the first file's entries are not read a second time.
    assert rows(jobs.stored_leaves(spark, at), "emp_id", "status") == [("1", "ACTIVE"), ("2", "ACTIVE")]
    table = jobs.stored_timeframe(spark, at)
    assert table.count() == 41 and rows(table.filter("emp_id = '7'"), "designation", "status") == [("Dev", "INACTIVE"), ("Lead", "ACTIVE")]
    stored = rows(table)
    jobs.retire(spark, at, keep=1)
    assert rows(jobs.stored_timeframe(spark, at)) == stored and len(jobs.timeframe(spark, at).log.numbers()) == 1


def test_strike_out_without_a_delivery(spark, tmp_path, rows):
    at = jobs.Places(str(tmp_path / "raw"), str(tmp_path / "store"))
    put(at, "timeframe", "emp_id,designation,start_date,end_date,salary\n1,Dev,1672531200,,1000\n2,QA,1672531200,,900\n")
    daily.run_day(spark, at, day_of("2024-03-04T07:00:00"))
    struck = spark.createDataFrame([("1",)], "employee_id string")
    struck.write.parquet(f"{at.stored('strikes')}/struck_out/block=000000000000/origin=stream-0")
    for day in ("2024-03-05T07:00:00", "2024-03-06T07:00:00"):
        done = daily.run_day(spark, at, day_of(day))
        assert done["timeframe"] == "no input"
        got = jobs.stored_timeframe(spark, at).filter("emp_id = '1'")
        assert rows(got, "end_date", "status") == [(D("2024-03-05"), "INACTIVE")]


def test_a_corrected_quota_replaces_the_stored_one(spark, tmp_path, rows):
    at = jobs.Places(str(tmp_path / "raw"), str(tmp_path / "store"))
    put_more(at, "quota", "a.csv", "emp_id,leave_quota,year\n1,20,2024\n2,20,2024\n1,18,2023\n")
    assert jobs.load_quota(spark, at)
    put_more(at, "quota", "b.csv", "emp_id,leave_quota,year\n1,25,2024\n")
    assert jobs.load_quota(spark, at) and not jobs.load_quota(spark, at)
    assert rows(jobs.stored_quota(spark, at)) == [(1, 18, 2023), (1, 25, 2024), (2, 20, 2024)]


def test_alerts_of_two_runs_of_a_day_stay(spark, tmp_path):
    from rosterline.operators import reports
    from rosterline.sources import files

    path = str(tmp_path / "alerts")
    flagged = [("a", 9, 10, 90.0), ("b", 9, 10, 90.0), (None, 9, 10, 90.0)]
    frame = lambda r: spark.createDataFrame(r, "emp_id string, leaves_taken long, leave_quota int, leave_percent double")
    history = spark.createDataFrame([], "emp_id string")
    for run, people in ((1, flagged), (2, [*flagged, ("c", 9, 10, 90.0)]), (2, [*flagged, ("c", 9, 10, 90.0)])):
        fresh = reports.new_alerts(frame(people), history)
        files.write_alerts(reports.alert_lines(fresh, D("2024-02-01")), path, run=run)
        if run == 1:
            history = spark.createDataFrame(reports.alert_history(history, fresh).collect(), "emp_id string")
    texts = [r.value for r in files.read_alerts(spark, path).collect()]
    assert len(texts) == 4 and sum("Employee ID: c" in t for t in texts) == 1


def test_closing_one_person_writes_their_rows_only(spark, tmp_path, rows):
    at = jobs.Places(str(tmp_path / "raw"), str(tmp_path / "store"))
    head = "emp_id,designation,start_date,end_date,salary\n"
    put(at, "timeframe", head + "".join(f"{i},Dev,{1672531200 + n * 86400},,{1000 + n}\n" for i in range(300) for n in range(3)))
    jobs.load_timeframe(spark, at, D("2024-03-04"))
    table, published = jobs.timeframe(spark, at), []
    struck = spark.createDataFrame([("7",), ("9",)], "employee_id string")
    struck.write.parquet(f"{at.stored('strikes')}/struck_out/block=000000000000/origin=stream-0")
    jobs.close_struck(spark, at, D("2024-03-05"), lambda name, df, mode: published.append((name, mode, df.count())))
    assert [x["rows"] for x in table.head().state["layers"]] == [6] and published == [("timeframe", "replace emp_id", 6)]
    got = rows(jobs.stored_timeframe(spark, at).filter("emp_id in ('7', '9') and end_date = date'2024-03-05'"), "emp_id", "status")
    assert got == [("7", "INACTIVE"), ("9", "INACTIVE")] and jobs.stored_timeframe(spark, at).count() == 900
    number = table.head().number
    jobs.close_struck(spark, at, D("2024-03-06"))  # nobody is left to close
    assert table.head().number == number


def test_two_deliveries_at_once(spark, tmp_path, rows, monkeypatch):
    """A second job's delivery is merged while the first has read but not stored: no row is lost."""
    from rosterline.operators import periods

    at = jobs.Places(str(tmp_path / "raw"), str(tmp_path / "store"))
    other = jobs.Places(str(tmp_path / "other"), str(tmp_path / "store"))
    head = "emp_id,designation,start_date,end_date,salary\n"
    put(at, "timeframe", head + "1,Dev,1672531200,,1000\n2,QA,1672531200,,900\n")
    jobs.load_timeframe(spark, at, D("2024-03-04"))
    put_more(at, "timeframe", "b.csv", head + "1,Lead,1701388800,,1500\n")
    late = spark.createDataFrame([("1", "Senior", D("2023-06-01"), None, 1200.0)], "emp_id string, designation string, start_date date, end_date date, salary double")
    merge, tries = periods.merge_periods, []

    def interleaved(stored, fresh, **options):
        tries.append(len(tries))
        if len(tries) == 1:
            table = jobs.timeframe(spark, other)
            table.write(lambda base: merge(table.read(base).filter("emp_id = '1'"), late, order=["salary"]))
        return merge(stored, fresh, **options)

    monkeypatch.setattr(periods, "merge_periods", interleaved)
    jobs.load_timeframe(spark, at, D("2024-03-05"))
    assert len(tries) == 2
    assert rows(jobs.stored_timeframe(spark, at), "emp_id", "designation", "end_date") == [
        ("1", "Dev", D("2023-06-01")), ("1", "Lead", None), ("1", "Senior", D("2023-12-01")), ("2", "QA", None),
    ]


def test_retire_knows_the_employee_rows(spark, tmp_path):
    at = jobs.Places(str(tmp_path / "raw"), str(tmp_path / "store"))
    for day in (4, 5, 6):
        put_more(at, "employee", f"{day}.csv", f"name,age,emp_id\nAnn,30,{day}\n")
        jobs.load_employees(spark, at, D(f"2024-03-0{day}"))
    jobs.retire(spark, at, keep=1)
    from pathlib import Path

    assert [p.name for p in Path(at.stored("intake/employee-rows")).iterdir()] == ["day=2024-03-06"]
    assert spark.read.parquet(at.stored("employee")).count() == 3
