"""The strike stream on the file source."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rosterline.operators import messages, strikes
from rosterline.schemas import MESSAGE, rung_names
from rosterline.schemas import strikes as strike_schema
from rosterline.streaming import messages as io
from rosterline.streaming import strike_stream as ss

NOW = dt.datetime(2024, 3, 1, 12, tzinfo=dt.timezone.utc)
VOCAB = ["HELLO", "BAD", "WORLD"]


def message(sender, text="hello bad"):
    return json.dumps({"sender": sender, "receiver": "r", "message": text})


@pytest.fixture
def setup(spark, tmp_path):
    root = str(tmp_path / "state")
    start = spark.createDataFrame(
        [(e, 1000.0, *[None] * 10, n) for e, n in (("a", 0), ("b", 0), ("c", 9), ("d", None))], strike_schema()
    )
    ss.store_salaries(start, root, NOW - dt.timedelta(days=29))
    changes = []
    job = ss.StrikeStream(
        root, spark.createDataFrame([("BAD",)], "w string"), spark.createDataFrame([(w,) for w in VOCAB], "w string"),
        clock=lambda: NOW, on_changes=lambda df, k: changes.append((k, sorted(r[0] for r in df.collect()))),
    )
    return root, job, changes


def feed(tmp_path, name, lines):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def run(spark, folder, job, tmp_path):
    source = io.read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, path=folder)
    query = ss.start(source, job, str(tmp_path / "checkpoint"), every=None)
    query.awaitTermination()
    return query


def counts(spark, root):
    table = ss.strike_table(spark, root)
    return {r[0]: r[1] for r in table.select("employee_id", "no_of_strikes").collect()}


def test_stream_equals_batch_and_restarts(spark, setup, tmp_path):
    root, job, changes = setup
    lines = [
        [message("a"), message("b"), message("a"), message("a", "bad zzz"), "broken"],
        [message("c"), message("nobody"), message("b", "hello")],
        [message("a"), message("d")],
    ]
    for i, part in enumerate(lines[:2]):
        folder = feed(tmp_path, f"{i}.txt", part)
    run(spark, folder, job, tmp_path)
    assert counts(spark, root) == {"a": 2, "b": 1, "c": 1, "d": None}
    # A restart goes on from the checkpoint: only the new file is read.
    feed(tmp_path, "2.txt", lines[2])
    run(spark, folder, job, tmp_path)
    assert counts(spark, root) == {"a": 3, "b": 1, "c": 1, "d": 1}
    assert [k for k, _ in changes] == [0, 1, 2]

    data = spark.createDataFrame([(v,) for part in lines for v in part], "value string")
    found = messages.flag(messages.decode(data), ["BAD"], VOCAB, NOW)
    once = strikes.decay(found, NOW).join(
        spark.createDataFrame([(e, 1000.0) for e in "abcd"], "employee_id string, salary double"), "employee_id"
    )
    want = {tuple(r) for r in strikes.ladder(once, rung_type="float").collect()}
    assert {tuple(r) for r in ss.strike_table(spark, root).collect()} == want


def test_replayed_batch_changes_nothing(spark, setup):
    root, job, _ = setup
    gone = []
    job.on_struck = lambda df, k: gone.append((k, [r[0] for r in df.collect()]))
    first = spark.createDataFrame([(message("a"),), (message("b"),)], "value string")
    second = spark.createDataFrame([(message("a"),)] * 9, "value string")
    ss.strike_batch(first, 0, job)
    ss.strike_batch(second, 1, job)
    state = {tuple(r) for r in ss.strike_table(spark, root).collect()}
    assert counts(spark, root)["a"] == 10
    assert [r[0] for r in ss.struck_out_table(spark, root).collect()] == ["a"]
    ss.strike_batch(second, 1, job)
    assert {tuple(r) for r in ss.strike_table(spark, root).collect()} == state
    assert [r[0] for r in ss.struck_out_table(spark, root).collect()] == ["a"]
    assert ss.flag_log(spark, root).count() == 11
    assert gone == [(0, []), (1, ["a"]), (1, ["a"])]
    # Somebody who is struck out is not scored again.
    ss.strike_batch(second, 2, job)
    assert {tuple(r) for r in ss.strike_table(spark, root).collect()} == state


def test_folding_changes_nothing(spark, setup):
    """Blocks of two batches: two folds on the way, a replay at a block's edge included."""
    root, job, _ = setup
    job.block = 2
    one = spark.createDataFrame([(message("a"),), (message("b", "hello"),)], "value string")
    for k in (0, 1, 2, 2, 3, 4):
        ss.strike_batch(one, k, job)
    table = ss.strike_table(spark, root, block=2)
    assert {r[0]: r[-1] for r in table.collect()} == {"a": 5, "b": 0, "c": 9, "d": None}
    assert ss.flag_log(spark, root, block=2).count() == 5
    made = ss.layout(spark, root)
    for state in (ss.strike_rows(spark, root, made).head().state, ss.flag_rows(spark, root, made).head().state):
        assert state["bases"] and len(state["layers"]) <= 3  # a block, and the batch since


def test_a_salary_sync_between_batches_is_used(spark, setup):
    root, job, _ = setup
    one = spark.createDataFrame([(message("a"),)], "value string")
    ss.strike_batch(one, 0, job)
    active = spark.createDataFrame([("a", 2000.0)], "emp_id string, salary double")
    rows = strikes.sync_salaries(active, ss.strike_table(spark, root))
    ss.store_salaries(rows, root, NOW + dt.timedelta(hours=1))
    job.clock = lambda: NOW + dt.timedelta(hours=2)
    ss.strike_batch(one, 1, job)
    row = ss.strike_table(spark, root).filter("employee_id = 'a'").first()
    assert (row["salary"], row["strike_1"], row["strike_2"], row["no_of_strikes"]) == (2000.0, 1800.0, 1620.0, 2)


def test_batch_without_flags_stores_no_strikes(spark, setup):
    root, job, changes = setup
    ss.strike_batch(spark.createDataFrame([(message("a", "hello"),)], "value string"), 0, job)
    assert changes == [] and counts(spark, root)["a"] == 0


def test_old_flags_do_not_count(spark, setup):
    root, job, _ = setup
    one = spark.createDataFrame([(message("a"),)], "value string")
    job.clock = lambda: NOW - dt.timedelta(days=31)
    ss.strike_batch(one, 0, job)
    job.clock = lambda: NOW
    ss.strike_batch(one, 1, job)
    assert counts(spark, root)["a"] == 1


def test_messages_to_files_and_back(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    data = spark.createDataFrame([("a", "b", "hi"), ("a", None, "x")], MESSAGE)
    io.write_messages(messages.encode(data), "text", path=path)
    assert rows(messages.decode(spark.read.text(path))) == [("a", "b", "hi")]


def test_kafka_options():
    assert io.kafka_source_options("h:1", "t", max_offsets=10) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "maxOffsetsPerTrigger": "10",
    }
    assert "maxOffsetsPerTrigger" not in io.kafka_source_options("h:1", "t")
    assert io.kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def sync(spark, root, pay, asof):
    active = spark.createDataFrame(pay, "emp_id string, salary double")
    rows = strikes.sync_salaries(active, ss.strike_table(spark, root, without=ss.sync_origin(asof)))
    return ss.store_salaries(rows, root, asof)


def salaries(spark, root):
    return {r[0]: r[1] for r in ss.strike_table(spark, root).select("employee_id", "salary").collect()}


def test_repeated_syncs_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "state")
    pay = [("x", 100.0), ("y", 200.0)]
    for hour in (7, 7, 9):
        sync(spark, root, pay, NOW.replace(hour=hour))
        assert salaries(spark, root) == {"x": 100.0, "y": 200.0}


def test_a_sync_after_quiet_blocks_stays(spark, setup):
    """Seven batches without a flag in blocks of two, then a raise and a new hire."""
    root, job, _ = setup
    job.block = 2
    flagged = spark.createDataFrame([(message("a"),)], "value string")
    quiet = spark.createDataFrame([(message("a", "hello"),)], "value string")
    ss.strike_batch(flagged, 0, job)
    for k in range(1, 8):
        ss.strike_batch(quiet, k, job)
    sync(spark, root, [("a", 1500.0), ("b", 1000.0), ("new", 700.0)], NOW + dt.timedelta(hours=1))
    job.clock = lambda: NOW + dt.timedelta(hours=2)
    for k in range(8, 13):
        assert salaries(spark, root) == {"a": 1500.0, "b": 1000.0, "c": 1000.0, "d": 1000.0, "new": 700.0}
        ss.strike_batch(quiet, k, job)
    ss.strike_batch(spark.createDataFrame([(message("new"),)], "value string"), 13, job)
    assert counts(spark, root) == {"a": 1, "b": 0, "c": 9, "d": None, "new": 1}
    # Nothing in use is removed with what was folded.
    before = {tuple(r) for r in ss.strike_table(spark, root).collect()}
    ss.retire(spark, root, keep=1)
    assert {tuple(r) for r in ss.strike_table(spark, root).collect()} == before
    assert ss.flag_log(spark, root).count() == 2
    ss.strike_batch(flagged, 14, job)
    assert counts(spark, root)["a"] == 2


def test_a_batch_stored_between_a_sync_and_its_moment(spark, setup):
    root, job, _ = setup
    job.clock = lambda: NOW + dt.timedelta(hours=3)
    ss.strike_batch(spark.createDataFrame([(message("a"),)], "value string"), 0, job)
    out = sync(spark, root, [("a", 150.0), ("b", 1000.0)], NOW)  # began before the batch
    assert [(r.employee_id, r.salary) for r in out.collect()] == [("a", 150.0)]
    row = ss.strike_table(spark, root).filter("employee_id = 'a'").first()
    assert (row["salary"], row["no_of_strikes"]) == (150.0, 1)


def test_another_layout_is_refused(spark, setup):
    root, job, _ = setup
    job.block = 1000
    ss.strike_batch(spark.createDataFrame([(message("a"),)], "value string"), 1001, job)
    assert counts(spark, root)["a"] == 1
    for wrong in ({"block": 100}, {"limit": 5}):
        with pytest.raises(ValueError):
            ss.strike_table(spark, root, **wrong)
    job.days = 60
    with pytest.raises(ValueError):
        ss.strike_batch(spark.createDataFrame([(message("a"),)], "value string"), 1002, job)


def test_a_one_sender_batch_opens_its_files_only(spark, setup, monkeypatch):
    """Through two splits: what such a batch opens does not grow with the store, and the table is the same."""
    root, job, _ = setup
    job.block = 2
    monkeypatch.setattr(ss.layers.Table, "most", 40)
    started = ss.strike_rows

    def small(spark, root, made):
        table = started(spark, root, made)
        table.most = 40
        return table

    monkeypatch.setattr(ss, "strike_rows", small)
    for n in range(3):
        people = [(f"p{i}", 1000.0, *[None] * 10, 0) for i in range(n * 60, n * 60 + 60)]
        ss.store_salaries(spark.createDataFrame(people, strike_schema()), root, NOW - dt.timedelta(days=20 - n))
        ss.strike_batch(spark.createDataFrame([(message(f"p{i}"),) for i in range(n * 60 + 60)], "value string"), n, job)
    ss.strike_batch(spark.createDataFrame([(message("a"),)], "value string"), 3, job)
    ss.strike_batch(spark.createDataFrame([(message("a"),)], "value string"), 4, job)
    table = small(spark, root, ss.layout(spark, root))
    bases = table.head().state["bases"]
    assert max(map(len, bases)) >= 2 and sum(b["rows"] for b in bases.values()) >= 180
    slots = table.slots(spark.createDataFrame([("a",)], "employee_id string"))
    opened, all_ = set(table.read(slots=slots).inputFiles()), set(table.read().inputFiles())
    assert len({f.rpartition("/")[0] for f in opened}) <= 4 < len({f.rpartition("/")[0] for f in all_})
    got = counts(spark, root)
    assert got["a"] == 2 and [got[f"p{i}"] for i in (0, 59, 60, 119, 120, 179)] == [3, 3, 2, 2, 1, 1]


def test_struck_out_people_are_folded(spark, setup):
    root, job, _ = setup
    job.block = 2
    ss.strike_batch(spark.createDataFrame([(message("c"),)], "value string"), 0, job)
    ten = spark.createDataFrame([(message("b"),)] * 10, "value string")
    for k in range(1, 7):
        ss.strike_batch(ten if k == 3 else spark.createDataFrame([(message("d", "hello"),)], "value string"), k, job)
    ss.retire(spark, root, keep=1)
    assert [r[0] for r in ss.struck_out_table(spark, root).collect()] == ["b"]
