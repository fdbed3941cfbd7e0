"""Versions of a table with a digest of every bucket of keys; buckets that agree are not read to compare.

    rows/version=V/bucket=B    the rows of a version, by a hash of the key
    digests/version=V          one row per bucket that has rows; written last, so it completes the version

A digest is the number of rows and the sums of two independent 64-bit hashes of whole rows, in halves.
It does not depend on the order of rows, repeated rows count, and parts of it add up, so it is an
ordinary aggregate. Two versions are compared by their digests first, a few numbers per bucket; only
buckets that differ are opened, by path, and joined. So the cost follows the buckets that changed.
Buckets that differ unseen would need two equal sums of 128 hash bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import any_differs, same_keys
from . import versions
from .files import empty_frame

# Buckets of a table, unless given: the more, the less is read for a few changes; a bucket should
# still fill a file.
BUCKETS = 256
BUCKET, OLD, NEW = "bucket", "_in_old", "_in_new"
# What the two hashes of a row begin with, and the mask of a hash's lower half.
SALTS = (0, 1)
HALF = 0xFFFFFFFF


def row_digests(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The digest of all rows of each group: n, and four sums.

    Nulls are values of their own, the column that holds one counts. A sum takes 2^31 rows of a
    group before it overflows, which is an error and not a wrong digest. Columns of maps cannot be hashed.
    """
    columns = [F.col(f"`{c}`") for c in df.columns if c not in by]
    sums = []
    for salt in SALTS:
        of_row = F.xxhash64(F.lit(salt), *[c.isNull() for c in columns], *columns)
        sums.append(F.sum(F.shiftrightunsigned(of_row, 32)).alias(f"high_{salt}"))
        sums.append(F.sum(of_row.bitwiseAND(F.lit(HALF))).alias(f"low_{salt}"))
    return df.groupBy(*by).agg(F.count("*").alias("n"), *sums)


def write(df: DataFrame, root: str, keys: Sequence[str], buckets: int = BUCKETS) -> int:
    """Write the next version of a table and its digests; returns its number.

    The digests are those of the rows as stored, so df is computed once. A version whose digests
    are missing was not completed and is written again.
    """
    if BUCKET in df.columns:
        raise ValueError(f"a column is called {BUCKET}")
    spark = df.sparkSession
    number = (versions.latest(spark, f"{root}/digests") or 0) + 1
    # the keys as text, so that a key's bucket does not depend on its type
    place = F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(buckets)).cast("int")
    versions.write_next(df.withColumn(BUCKET, place), f"{root}/rows", [BUCKET], rebalance=True, number=number)
    stored = spark.read.schema(df.withColumn(BUCKET, place).schema).parquet(versions.version_path(f"{root}/rows", number))
    made = row_digests(stored, [BUCKET]).withColumns({"buckets": F.lit(buckets), "types": F.lit(df.schema.simpleString())})
    versions.write_next(made.coalesce(1), f"{root}/digests", number=number)
    return number


def _digests(spark: SparkSession, root: str, number: int) -> dict[int, tuple]:
    """The digest of each bucket of a version that has rows; as many as there are buckets at most."""
    rows = spark.read.parquet(versions.version_path(f"{root}/digests", number)).collect()
    return {r[BUCKET]: tuple(r[c] for c in sorted(r.asDict()) if c != BUCKET) for r in rows}


def read(spark: SparkSession, root: str, like: DataFrame | None = None, number: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """The rows of a version (the newest), or of some of its buckets, which are opened by path.

    Without any, the columns are those of `like` (None: no frame).
    """
    number = versions.latest(spark, f"{root}/digests") if number is None else number
    path = versions.version_path(f"{root}/rows", number) if number else None
    held = [] if path is None else [b for b in _digests(spark, root, number) if buckets is None or b in set(buckets)]
    if not held:
        return None if like is None else empty_frame(spark, like.schema)
    return spark.read.option("basePath", path).parquet(*[f"{path}/{BUCKET}={b}" for b in sorted(held)]).drop(BUCKET)


def differing(spark: SparkSession, root: str, old: int, new: int) -> list[int]:
    """The buckets whose digests differ between two versions.

    If the versions have other columns, types or numbers of buckets, those are all buckets of both.
    """
    before, after = _digests(spark, root, old), _digests(spark, root, new)
    return sorted(b for b in before.keys() | after.keys() if before.get(b) != after.get(b))


def compare(spark: SparkSession, root: str, keys: Sequence[str], old: int | None = None, new: int | None = None) -> DataFrame | None:
    """The rows that were added, changed (as they are now) or removed (as they were), with `change`.

    Compares the last two versions, or those given. Values are compared in the old version's types,
    nulls as values; a null key part matches a null. Keys are unique in a version
    (`merge.duplicate_keys`). Without an older version every row was added. If nothing differs, or the
    newer version is empty and there is no older one, no table is read; None if neither has any row.
    """
    done = versions.versions(spark, f"{root}/digests")
    new = (done[-1] if done else None) if new is None else new
    if new is None:
        return None
    if old is None:
        earlier = [v for v in done if v < new]
        old = earlier[-1] if earlier else None
    buckets = None if old is None else differing(spark, root, old, new)
    after = read(spark, root, number=new, buckets=buckets)
    before = None if old is None else read(spark, root, number=old, buckets=buckets)
    if after is None and before is None:
        whole = read(spark, root, number=new)
        return None if whole is None else empty_frame(spark, whole.schema).withColumn("change", F.lit(""))
    after = empty_frame(spark, before.schema) if after is None else after
    before = empty_frame(spark, after.schema) if before is None else before
    types = {c: t for c, t in before.dtypes if c not in keys and c in after.columns}
    joined = before.withColumn(OLD, F.lit(True)).alias("o").join(after.withColumn(NEW, F.lit(True)).alias("n"), same_keys("n", "o", keys), "full_outer")
    gone = F.col(NEW).isNull()
    change = F.when(F.col(OLD).isNull(), "added").when(gone, "removed")
    change = change.when(any_differs("n", "o", types), "changed") if types else change
    picked = [
        (F.when(gone, F.col(f"o.`{c}`")).otherwise(F.col(f"n.`{c}`")) if c in before.columns else F.col(f"n.`{c}`")).alias(c)
        for c in after.columns
    ]
    return joined.withColumn("change", change).filter("change IS NOT NULL").select(*picked, "change")


def retire(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove all versions but the newest `keep`; a version's digests go first."""
    versions.retire_versions(spark, f"{root}/digests", keep)
    left = versions.versions(spark, f"{root}/digests")
    for number in versions.versions(spark, f"{root}/rows"):
        if left and number < left[0]:
            versions.remove(spark, versions.version_path(f"{root}/rows", number))
