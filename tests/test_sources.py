"""File sources and sinks, versions, JDBC options."""

import json

import pytest

from rosterline.schemas import CALENDAR, EMPLOYEE
from rosterline.session import scratch_path, shared_dir
from rosterline.sources import files, jdbc, versions

PLACE = {"url": "jdbc:db://place", "user": "u"}


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_csv_matches_by_position(spark, tmp_path, rows):
    path = put(tmp_path / "c", "a.csv", "emp_id,who,years\nAnn,30,1\nBob,x,2\n")
    assert rows(files.read_csv(spark, path, EMPLOYEE)) == [("Ann", 30, 1), ("Bob", None, 2)]


def test_csv_as_text(spark, tmp_path, rows):
    path = put(tmp_path / "c", "a.csv", "name,age\nAnn,030\n")
    assert rows(files.read_csv(spark, path)) == [("Ann", "030")]


def test_csv_without_header_takes_every_line(spark, tmp_path, rows):
    path = put(tmp_path / "c", "a.csv", "reason,date\nNew Year,2024-01-01 00:00:00\n")
    got = rows(files.read_csv(spark, path, CALENDAR, header=False), "reason")
    assert got == [("New Year",), ("reason",)]
    assert files.read_csv(spark, path, CALENDAR, header=False).filter("date IS NULL").count() == 1


def test_read_or_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    assert files.read_or_empty(spark, path, EMPLOYEE).schema == EMPLOYEE
    assert files.read_or_empty(spark, path, EMPLOYEE).isEmpty()
    put(tmp_path / "bad", "x.parquet", "this is not parquet")
    with pytest.raises(Exception):
        files.read_or_empty(spark, str(tmp_path / "bad"), EMPLOYEE).collect()


def test_word_list(spark, tmp_path, rows):
    path = put(tmp_path / "w", "a.json", json.dumps(["BAD", "GOOD", "BAD", "ÉTÉ"], indent=2, ensure_ascii=False))
    assert rows(files.read_word_list(spark, path)) == [("BAD",), ("GOOD",), ("ÉTÉ",)]


def test_source_file(spark, tmp_path):
    path = put(tmp_path / "c", "a.csv", "name,age,id\nAnn,30,1\n")
    put(tmp_path / "c", "b.csv", "name,age,id\nBob,30,2\n")
    df = files.read_csv(spark, path, EMPLOYEE)
    assert {r.source_file.rsplit("/", 1)[1] for r in files.with_source_file(df).collect()} == {"a.csv", "b.csv"}
    assert files.input_files(df).count() == 2


def test_dynamic_overwrite_keeps_other_days(spark, tmp_path, rows):
    path = str(tmp_path / "r")
    for day, n in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)):
        df = spark.createDataFrame([(n, day)], "n int, run_date string")
        files.write_parquet(df, path, "overwrite", ["run_date"], dynamic=True)
    assert rows(spark.read.parquet(path), "n") == [(1,), (3,)]


def test_csv_append(spark, tmp_path, rows):
    path = str(tmp_path / "o")
    df = spark.createDataFrame([("Ann", 30, 1)], EMPLOYEE)
    files.write_csv(df, path)
    files.write_csv(df, path)
    assert rows(files.read_csv(spark, path, EMPLOYEE)) == [("Ann", 30, 1)] * 2


def test_versions_are_never_overwritten(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    assert versions.read_latest(spark, root, EMPLOYEE).isEmpty()
    assert versions.write_next(spark.createDataFrame([("Ann", 30, 1)], EMPLOYEE), root) == 1
    stored = versions.read_latest(spark, root, EMPLOYEE)
    assert versions.write_next(stored.union(stored), root) == 2
    assert stored.count() == 1
    assert versions.read_latest(spark, root, EMPLOYEE).count() == 2
    # A write that did not finish is not seen, and is replaced by the next one.
    put(tmp_path / "t" / "version=00000003", "part-0.parquet", "half written")
    assert versions.versions(spark, root) == [1, 2]
    assert versions.write_next(stored, root) == 3


def test_ingest_once_reads_new_files_and_archives(spark, tmp_path, rows):
    raw, archive = tmp_path / "raw", tmp_path / "archive"
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    path = put(raw, "a.csv", "name,age,id\nAnn,30,1\n")

    def sink(df, batch_id):
        files.write_parquet(df, f"{out}/batch={batch_id}", "overwrite")

    for i, name in enumerate(("b", "c", "d")):
        files.ingest_once(spark, path, EMPLOYEE, sink, state, archive=str(archive))
        put(raw, f"{name}.csv", f"name,age,id\nP{i},30,{i}\n")
    files.ingest_once(spark, path, EMPLOYEE, sink, state, archive=str(archive))
    got = rows(spark.read.schema(EMPLOYEE).parquet(f"{out}/batch=*"), "name")
    assert got == [("Ann",), ("P0",), ("P1",), ("P2",)]
    assert any(p.name == "a.csv" for p in archive.rglob("*.csv"))


def test_jdbc_read_options():
    assert jdbc.read_options(PLACE, table="t") == {**PLACE, "dbtable": "t", "fetchsize": "10000"}
    assert jdbc.read_options(PLACE, query="SELECT 1")["dbtable"] == "(SELECT 1) AS q"
    many = jdbc.read_options(PLACE, table="t", partition_column="id", lower=0, upper=9, partitions=3)
    assert many["partitionColumn"] == "id" and many["numPartitions"] == "3" and many["upperBound"] == "9"
    with pytest.raises(ValueError):
        jdbc.read_options(PLACE)
    with pytest.raises(ValueError):
        jdbc.read_options(PLACE, table="t", partition_column="id")


def test_jdbc_write_options():
    got = jdbc.write_options(PLACE, "t", partitions=4)
    assert got == {**PLACE, "dbtable": "t", "truncate": "true", "batchsize": "10000", "numPartitions": "4"}


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """Stands in for a database: Parquet directories that are emptied before an overwrite."""
    import shutil

    def read(session, options, table=None, **kw):
        return session.read.parquet(str(tmp_path / table))

    def write(df, options, table, mode="append", **kw):
        if mode == "overwrite":
            shutil.rmtree(tmp_path / table, ignore_errors=True)
        df.write.mode("append").parquet(str(tmp_path / table))

    monkeypatch.setattr(jdbc, "read_jdbc", read)
    monkeypatch.setattr(jdbc, "write_jdbc", write)
    return lambda name: spark.read.parquet(str(tmp_path / name))


def test_word_list_by_lines(spark, tmp_path, rows):
    (tmp_path / "words.txt").write_text("BAD\n\n WORSE \nBAD\n")
    assert rows(files.read_word_list(spark, str(tmp_path), lines=True)) == [("BAD",), ("WORSE",)]


def test_upsert_stages_the_changes_only(spark, tables, rows):
    jdbc.write_jdbc(spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int"), PLACE, "t")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "id string, n int")
    said = []
    jdbc.upsert_jdbc(PLACE, new, "t", "t_staging", ["id"], said.append)
    assert rows(tables("t")) == [("a", 1), ("b", 2)] and rows(tables("t_staging")) == [("b", 9), ("c", 3)]
    assert said == [
        "MERGE INTO t AS t USING t_staging AS s ON (t.id = s.id OR (t.id IS NULL AND s.id IS NULL)) "
        "WHEN MATCHED THEN UPDATE SET n = COALESCE(s.n, t.n) WHEN NOT MATCHED THEN INSERT (id, n) VALUES (s.id, s.n)"
    ]


def test_publisher(spark, tables, rows):
    said = []
    publish = jdbc.publisher(PLACE, {"x": "tx", "s": "ts"}, {"s": ["id"]}, said.append)
    df = spark.createDataFrame([("a", 1)], "id string, n int")
    publish("x", df, "append")
    publish("x", df, "append")
    publish("other", df, "overwrite")
    publish("s", df, "upsert")
    assert rows(tables("tx")) == [("a", 1), ("a", 1)]
    assert rows(tables("ts_staging")) == [("a", 1)] and "n = s.n" in said[0]
    with pytest.raises(ValueError):
        jdbc.publisher(PLACE, {"s": "ts"})("s", df, "upsert")


def test_shared_folder_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        assert shared_dir(spark) == named.rstrip("/")
        assert scratch_path(spark, "x").startswith(named.rstrip("/"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_two_rewrites_of_one_part_lose_no_row(spark, tmp_path):
    from pyspark.sql import functions as F
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from rosterline.sources import versions

    schema = StructType([StructField("p", StringType()), StructField("v", LongType())])
    root, tries = str(tmp_path / "t"), []
    rows = lambda *r: spark.createDataFrame(r, schema)
    add = lambda *r: versions.update_parts(spark, root, schema, F.col("p"), sorted({p for p, _ in r}), lambda stored: stored.union(rows(*r)))
    add(("a", 1), ("b", 1))

    def interleaved(stored):
        tries.append(1)
        if len(tries) == 1:
            add(("a", 2))
            add(("c", 9))  # another part: no reason to compute again
        return stored.union(rows(("a", 3)))

    versions.update_parts(spark, root, schema, F.col("p"), ["a"], interleaved)
    held = lambda: sorted(map(tuple, versions.read_parts(spark, root, schema).collect()))
    assert len(tries) == 2 and held() == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 9)]
    versions.retire_parts(spark, root)
    assert held() == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 9)]


def test_tables_of_steps_are_removed(spark):
    from pathlib import Path

    from rosterline.session import clear_scratch, scratch_path

    clear_scratch(spark)
    path = scratch_path(spark, "step")
    spark.range(3).write.parquet(path)
    assert Path(path.removeprefix("file://")).exists() and clear_scratch(spark) == 1
    assert not Path(path.removeprefix("file://")).exists() and clear_scratch(spark) == 0
