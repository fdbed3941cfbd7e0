"""Layered tables: commits of several writers, folds, splits, changes."""

import pytest

from rosterline.sources import commits, layers

SCHEMA = "k string, v long"


def table(spark, path, **options):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("k", StringType()), StructField("v", LongType())])
    return layers.Table(spark, str(path), schema, "k", **options)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def put(t, rows, **options):
    return t.write(lambda at: frame(t.spark, rows), **options)


def held(t, **options):
    return sorted((tuple(r) for r in t.read(**options).collect()), key=repr)


def test_layers_replace_by_key(spark, tmp_path):
    t = table(spark, tmp_path, share=10)
    assert held(t) == []
    put(t, [("a", 1), ("a", 2), ("b", 3), (None, 9)])
    put(t, [("a", 4)])
    put(t, [])
    assert held(t) == sorted([("a", 4), ("b", 3), (None, 9)], key=repr)
    written = [x["rows"] for x in t.head().state["layers"]]
    assert written == [1]  # the first delivery is the base, the second one row
    t.fold([""])
    assert held(t) == sorted([("a", 4), ("b", 3), (None, 9)], key=repr) and not t.head().state["layers"]


def test_a_log_keeps_all_rows(spark, tmp_path):
    t = table(spark, tmp_path, replaces=False)
    put(t, [("a", 1)], origin="x")
    put(t, [("a", 2)], origin="y")
    put(t, [("a", 3), ("b", 3)], origin="y")
    assert held(t) == [("a", 1), ("a", 3), ("b", 3)] and held(t, without="y") == [("a", 1)]
    t.fold()
    assert held(t) == [("a", 1), ("a", 3), ("b", 3)] and not t.head().state["layers"]


def test_two_interleaved_writers_lose_no_row(spark, tmp_path):
    """Both read the same state; the second to commit computes again from what the first left."""
    first, second = table(spark, tmp_path, share=10), table(spark, tmp_path, share=10)
    put(first, [("a", 1), ("b", 1)])
    tries = []

    def add_one(at):
        tries.append(at.number)
        rows = second.read(at)
        if len(tries) == 1:  # the other writer commits between this one's read and its commit
            first.write(lambda at: first.read(at).selectExpr("k", "v + 10 as v").filter("k = 'a'"))
        return rows.selectExpr("k", "v + 1 as v")

    second.write(add_one)
    assert len(tries) == 2 and tries[0] < tries[1]
    assert held(first) == [("a", 12), ("b", 2)]


def test_writers_of_other_keys_do_not_wait_for_each_other(spark, tmp_path):
    t = table(spark, tmp_path, share=10)
    put(t, [(k, 0) for k in "abcdefgh"])
    tries = []

    def change(at):
        tries.append(at)
        put(t, [("a", 5)])
        return frame(spark, [("b", 7)])

    t.write(change)
    assert len(tries) == 1 and dict(held(t))["a"] == 5 and dict(held(t))["b"] == 7


def test_a_writer_that_never_gets_through_says_so(spark, tmp_path):
    t = table(spark, tmp_path)

    def always_late(at):
        put(t, [("a", at.number)])
        return frame(spark, [("a", -1)])

    with pytest.raises(commits.Conflict):
        t.write(always_late)


def test_a_commit_is_made_once(spark, tmp_path):
    log = commits.Log(spark, str(tmp_path))
    assert commits.create_if_absent(spark, f"{tmp_path}/commits/000000000001")
    assert not commits.create_if_absent(spark, f"{tmp_path}/commits/000000000001")
    assert log.head().number == 0  # its writer died before it named a state
    done = log.append(lambda s, n: s | {"x": n}, log.head(), set())
    assert done.number == 2 and log.head().state == {"x": 2}


def test_parts_split_and_readers_follow(spark, tmp_path):
    t = table(spark, tmp_path, most=50, share=0.1)
    want = {}
    for n in range(3):  # the base is split, and split again
        rows = [(f"e{i}", n) for i in range(n * 60, 300 + n * 100)]
        put(t, rows)
        want |= dict(rows)
        assert dict(held(t)) == want
    bases = t.head().state["bases"]
    assert max(map(len, bases)) >= 3 and max(b["rows"] for b in bases.values()) <= 50
    assert sum(b["rows"] for b in bases.values()) == len(want)
    some = t.slots(frame(spark, [("e7", 0)]))
    assert ("e7", 0) in held(t, slots=some)
    opened = t.read(slots=some).inputFiles()
    assert len({f.split("part=")[1].split("/")[0] for f in opened if "part=" in f}) == 1


def test_what_a_small_read_opens_does_not_grow_with_the_layers(spark, tmp_path):
    t = table(spark, tmp_path, most=100, share=10)
    put(t, [(f"e{i}", 0) for i in range(1000)])
    for n in range(6):
        put(t, [(f"e{n * 7 + 100}", n), (f"e{n * 11 + 300}", n)], origin=f"batch {n}")
    wanted = t.slots(frame(spark, [("e107", 0)]))
    places = {f.split("/rows/")[1].split("/")[0] for f in t.read(slots=wanted).inputFiles()}
    assert len(places) <= 3 and ("e107", 1) in held(t, slots=wanted)


def test_folds_by_share_and_by_number(spark, tmp_path):
    t = table(spark, tmp_path, most=50, layers=3, share=0.5)
    put(t, [(f"e{i}", 0) for i in range(200)])
    before = {p: b["place"] for p, b in t.head().state["bases"].items()}
    part = next(iter(before))
    slotted = frame(spark, [(f"e{i}", 0) for i in range(200)]).withColumn("s", layers.slot_of("k")).collect()
    own = [r.k for r in slotted if layers._bits(r.s).startswith(part)]
    put(t, [(k, 1) for k in own])
    after = {p: b["place"] for p, b in t.head().state["bases"].items()}
    assert {p for p in before if after[p] != before[p]} == {part}
    for n in range(4):
        put(t, [("e1", n + 5)])
    assert len(t.head().state["layers"]) <= 3
    assert dict(held(t)) == {f"e{i}": 1 if f"e{i}" in own else 0 for i in range(200)} | {"e1": 8}


def test_changes(spark, tmp_path):
    t = table(spark, tmp_path, share=10, layers=3)
    put(t, [(f"e{i}", 0) for i in range(50)])
    start = t.head().number
    assert t.changes(start).collect() == []
    put(t, [("e1", 1), ("e2", 1)])
    put(t, [("e2", 2), ("new", 2)])
    got = t.changes(start)
    assert sorted(map(tuple, got.collect())) == [("e1", 1), ("e2", 2), ("new", 2)]
    assert sorted(map(tuple, t.changes(start + 1).collect())) == [("e2", 2), ("new", 2)]
    before, after = t.differences(start)
    assert sorted(map(tuple, before.collect())) == [("e1", 0), ("e2", 0)]
    assert sorted(map(tuple, after.collect())) == [("e1", 1), ("e2", 2), ("new", 2)]
    for n in range(4):
        put(t, [("e9", n)])
    assert len(t.head().state["layers"]) <= 3  # folded, and still known
    assert sorted(map(tuple, t.changes(start).collect())) == [("e1", 1), ("e2", 2), ("e9", 3), ("new", 2)]
    for n in range(8):
        put(t, [("e9", n)])
    assert t.changes(start) is None  # too long ago: the reader takes the whole table
    late = t.head().number
    t.retire(keep=1)
    assert dict(held(t))["e9"] == 7 and len(t.log.numbers()) == 1
    assert t.changes(late).collect() == [] and t.changes(late - 1) is not None


def test_one_layer_is_put_over_the_base_by_one_join(spark, tmp_path):
    """No layer lies over another: its rows are read for their keys and as they are, without a search for the newest."""
    t = table(spark, tmp_path, share=10)
    put(t, [("a", 1), ("b", 1), (None, 1)])
    put(t, [("a", 2), ("a", 3), (None, 2)])
    plan = t.read(slots=set(range(layers.SLOTS)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "element_at" not in plan  # all hash ranges: no filter by them
    assert held(t) == sorted([("a", 2), ("a", 3), ("b", 1), (None, 2)], key=repr)
    put(t, [("a", 4)])
    assert held(t) == sorted([("a", 4), ("b", 1), (None, 2)], key=repr)


def test_a_fold_reads_parts_that_no_split_concerns_once(spark, tmp_path):
    """Rows of such parts are counted as written; before, every fold computed them twice."""
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def noted(k):
        seen.add(1)
        return True

    t = table(spark, tmp_path, replaces=False, most=50)
    put(t, [(f"e{i}", 0) for i in range(100)], origin="x")
    t.fold(keep=lambda rows: rows.filter(noted("k")))
    assert seen.value == 200 and len(t.head().state["bases"]) > 1  # the first is to be split: counted and written
    put(t, [(f"e{i}", 1) for i in range(4)], origin="y")
    parts = [p for p, b in t.head().state["bases"].items() if b["rows"] + 4 <= 50]
    rows = sum(b["rows"] for p, b in t.head().state["bases"].items() if p in parts)
    new = sum(n for x in t.head().state["layers"] for s, n in x["slots"].items() if any(layers._bits(int(s)).startswith(p) for p in parts))
    t.fold(parts, keep=lambda rows: rows.filter(noted("k")))
    assert parts and seen.value == 200 + rows + new
    assert sum(b["rows"] for p, b in t.head().state["bases"].items() if p in parts) == rows + new
    assert len(held(t)) == 104


def test_parts_that_cannot_be_split_are_kept_and_counted(spark, tmp_path):
    """Hash ranges at full depth hold more than `most`; folds go on, an emptied part reads as none."""
    t = table(spark, tmp_path, replaces=False, most=1, share=0.1)
    put(t, [("a", i) for i in range(9)] + [("b", 0)], origin="x")
    t.fold()
    full = {p: b["rows"] for p, b in t.head().state["bases"].items() if b["rows"]}
    assert sorted(full.values()) == [1, 9] and max(map(len, full)) == layers.SLOT_BITS
    put(t, [("a", 9), ("b", 1)], origin="y")
    t.fold()
    assert sorted(b["rows"] for b in t.head().state["bases"].values() if b["rows"]) == [2, 10] and len(held(t)) == 12
    t.fold(list(t.head().state["bases"]), keep=lambda rows: rows.filter("v < 0"))
    assert held(t) == [] and not any(b["rows"] for b in t.head().state["bases"].values())


def test_a_table_of_all_parts_is_listed_by_few_tasks(spark):
    """One task for each of up to SLOTS parts took seconds a read."""
    from rosterline.session import tune

    assert int(tune(spark).conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 64
