"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import ACTIVE

# Fixed value: what stands between two alerts of a file.
ALERT_SEPARATOR = "\n\n"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under a path; none when it does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    return [entry.getPath().getName() for entry in fs.listStatus(where)]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or directory with all that is in it; a missing one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of a schema."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType | None = None, header: bool = True
) -> DataFrame:
    """CSV by declared schema, matched by position; without a schema all columns are text.

    Values that do not fit their type become null.
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
        # Positions decide, whatever the header calls the columns.
        reader = reader.option("enforceSchema", True)
    return reader.csv(path)


def read_active(spark: SparkSession, path: str, status: str = "status") -> DataFrame:
    """Open periods of a table partitioned by status; reads that partition only."""
    return spark.read.parquet(path).filter(F.col(status) == ACTIVE)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Earlier output, or an empty frame of the schema when there is none yet.

    Only a missing path counts as none; any other failure is raised.
    """
    if not path_exists(spark, path):
        return empty_frame(spark, schema)
    return spark.read.schema(schema).parquet(path)


def read_word_list(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Words of JSON array files as a one-column frame of distinct words.

    An array is read as one row; lines reads files of one word per line instead, which a
    long list should have, since Spark can split them.
    """
    if lines:
        return spark.read.text(path).select(F.trim("value").alias("word")).filter("word <> ''").distinct()
    arrays = spark.read.text(path, wholetext=True)
    words = arrays.select(F.explode(F.from_json("value", "array<string>")).alias("word"))
    return words.dropna().distinct()


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Adds the file each row was read from."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def input_files(df: DataFrame) -> DataFrame:
    """The distinct files a frame reads."""
    return df.select(F.col("_metadata.file_path").alias("source_file")).distinct()


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    dynamic: bool = False,
    rebalance: bool = False,
) -> None:
    """Parquet write.

    dynamic overwrites only the partitions present in df and keeps the others.
    rebalance evens out the files per partition value first: large values are split
    over several tasks, small ones are not scattered over many files.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "append", header: bool = True) -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_alerts(
    lines: DataFrame, path: str, key: str = "emp_id", per_employee: bool = False, run: int = 0
) -> None:
    """Alert texts under report_date and run, written by the executors.

    One set of files per run with a blank line between alerts, or, for numbers a
    person could read, one directory per employee. Writing a run again replaces that run
    and nothing else: alerts of earlier runs of the day stay.
    """
    parts = ["report_date", "run", key] if per_employee else ["report_date", "run"]
    out = lines.withColumn("run", F.lit(run))
    out = out.hint("rebalance", *parts) if per_employee else out
    (
        out.select(*parts, F.rtrim("value", F.lit("\n")).alias("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("lineSep", ALERT_SEPARATOR)
        .partitionBy(*parts)
        .text(path)
    )


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alert texts again, one row each."""
    return spark.read.option("lineSep", ALERT_SEPARATOR).text(path)


def ingest_once(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sink,
    checkpoint: str,
    archive: str | None = None,
    header: bool = True,
    max_files: int | None = None,
    max_age: str = "3650d",
):
    """Process the CSV files that are new since the last call, then archive them.

    sink(df, batch_id) gets each micro-batch. Which files are done is kept in the
    checkpoint, so a repeated call reads none of them twice; Spark moves a file to the
    archive once a later batch has been committed. A file is known by its path. Spark
    ignores files that are max_age older than the newest one.
    """
    reader = spark.readStream.schema(schema).option("header", header).option("maxFileAge", max_age)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.csv(path)
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
