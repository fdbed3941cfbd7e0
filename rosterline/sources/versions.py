"""Tables that are rewritten from themselves: a new directory per version.

Spark reads lazily, so overwriting a table that the new content is computed from
would delete the input. Each rewrite goes to its own version directory instead;
readers take the newest one whose write was completed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from .commits import Commit, Log, retried
from .files import child_names, empty_frame, path_exists, remove, write_parquet


def versions(spark: SparkSession, root: str) -> list[int]:
    """Completed versions, oldest first."""
    numbers = [
        int(name.removeprefix("version="))
        for name in child_names(spark, root)
        if name.startswith("version=")
    ]
    return sorted(n for n in numbers if path_exists(spark, f"{version_path(root, n)}/_SUCCESS"))


def version_path(root: str, version: int) -> str:
    return f"{root}/version={version:08d}"


def read_latest(
    spark: SparkSession, root: str, schema: StructType, upto: int | None = None
) -> DataFrame:
    """The newest completed version (not above upto), or an empty frame when there is none."""
    number = latest(spark, root, upto)
    if number is None:
        return empty_frame(spark, schema)
    return spark.read.schema(schema).parquet(version_path(root, number))


def latest(spark: SparkSession, root: str, upto: int | None = None) -> int | None:
    """The number of the newest completed version, not above upto."""
    done = [v for v in versions(spark, root) if upto is None or v <= upto]
    return done[-1] if done else None


def write_next(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    number: int | None = None,
) -> int:
    """Write the next (or the numbered) version and return its number; others stay readable."""
    if number is None:
        number = (latest(df.sparkSession, root) or 0) + 1
    # A directory left by a failed write has no success marker and is replaced.
    write_parquet(df, version_path(root, number), "overwrite", partition_by, rebalance=rebalance)
    return number


def retire_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove all completed versions but the newest `keep` (at least one, the one in use)."""
    for number in versions(spark, root)[: -max(1, keep)]:
        remove(spark, version_path(root, number))


# --- tables of which only some parts are rewritten -----------------------------------

PART = StructField("part", StringType(), True)


def read_parts(
    spark: SparkSession, root: str, schema: StructType, parts: Sequence[str] | None = None, at: Commit | None = None
) -> DataFrame:
    """The rows of every part, or of some parts, at a commit (the newest)."""
    held = (at or Log(spark, root).head()).state.get("parts", {})
    paths = [f"{root}/{place}/part={p}" for p, place in held.items() if parts is None or p in parts]
    paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        return empty_frame(spark, schema)
    typed = StructType([*schema.fields, PART, StructField("rows", StringType(), True)])
    return spark.read.schema(typed).option("basePath", root).parquet(*paths).select(*schema.fieldNames())


def update_parts(
    spark: SparkSession, root: str, schema: StructType, part: Column, touched: Sequence[str], compute: Callable[[DataFrame], DataFrame]
) -> int:
    """Write the touched parts anew, computed from their rows, and leave the others; returns the commit.

    part gives the part of each row as text; a touched part without rows becomes empty. The rows
    go to a place of their own, the commit that says so is last. If another writer has meanwhile
    changed one of these parts, it is computed again from what they hold then.
    """
    log = Log(spark, root)

    def attempt() -> int:
        base, place = log.head(), f"rows={uuid.uuid4().hex}"
        rows = compute(read_parts(spark, root, schema, touched, base)).withColumn("part", part)
        write_parquet(rows, f"{root}/{place}", "overwrite", ["part"], rebalance=True)

        def build(state: dict, number: int) -> dict:
            return {"parts": state.get("parts", {}) | dict.fromkeys(touched, place), "touched": list(touched)}

        return log.append(build, base, set(touched)).number

    return retried(attempt)


def retire_parts(spark: SparkSession, root: str) -> None:
    """Remove the rows of parts that a later commit has replaced; none in use is touched."""
    log = Log(spark, root)
    used = {f"{place}/part={p}" for p, place in log.head().state.get("parts", {}).items()}
    log.retire(1)
    for place in child_names(spark, root):
        if place.startswith("rows="):
            for name in child_names(spark, f"{root}/{place}"):
                if name.startswith("part=") and f"{place}/{name}" not in used:
                    remove(spark, f"{root}/{place}/{name}")
