"""Tables written between steps, so that a lost executor costs one step and not the whole job."""

from __future__ import annotations

import contextlib
import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

# Settings under which the plans of this package were made.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


@contextlib.contextmanager
def settings(spark):
    """Apply SETTINGS for the steps inside and put back what the session had."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df below spark.checkpoint.dir and return the table that was written."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def picked(df: DataFrame, *columns: str) -> DataFrame:
    """Only these columns, so that names an operator uses inside cannot clash with others."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def importable(spark) -> None:
    """Let Python workers import this package from where the driver has it, if they can see it."""
    folder = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if folder not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [folder, known]))


def small_batches(spark, rows: int = 1000) -> None:
    """Hand Python workers so many rows at a time: whole texts fill the buffers on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def small_table(spark, **columns: pa.Array) -> DataFrame:
    """A frame of a few values the driver holds; from an Arrow table, which needs no Python workers."""
    return spark.createDataFrame(pa.table(columns))
