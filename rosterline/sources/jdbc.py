"""JDBC tables. Connection settings always come from the caller."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_options(
    options: Mapping[str, str],
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read: a table or a query, in one or many partitions."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    out = dict(options)
    out["dbtable"] = table if table is not None else f"({query}) AS q"
    out["fetchsize"] = str(fetch_size)
    if partition_column:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partition column needs lower, upper and partitions")
        out.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return out


def read_jdbc(spark: SparkSession, options: Mapping[str, str], **kwargs) -> DataFrame:
    """A table or query; plain filters and column choices are pushed to the database."""
    return spark.read.format("jdbc").options(**read_options(options, **kwargs)).load()


def write_options(
    options: Mapping[str, str],
    table: str,
    truncate: bool = True,
    batch_size: int = 10_000,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC write; truncate keeps the table definition on overwrite."""
    out = dict(options)
    out.update(dbtable=table, truncate=str(truncate).lower(), batchsize=str(batch_size))
    if partitions:
        out["numPartitions"] = str(partitions)
    return out


def write_jdbc(
    df: DataFrame, options: Mapping[str, str], table: str, mode: str = "append", **kwargs
) -> None:
    df.write.format("jdbc").mode(mode).options(**write_options(options, table, **kwargs)).save()


def merge_statement(
    table: str, staging: str, columns: Sequence[str], keys: Sequence[str], mode: str = "coalesce"
) -> str:
    """The SQL that merges a staging table into a table by key; null keys match each other.

    "coalesce" keeps a stored value where the staged one is null, "replace" takes the row.
    """
    if mode not in ("coalesce", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    same = " AND ".join(f"(t.{k} = s.{k} OR (t.{k} IS NULL AND s.{k} IS NULL))" for k in keys)
    value = "COALESCE(s.{0}, t.{0})" if mode == "coalesce" else "s.{0}"
    sets = ", ".join(f"{c} = {value.format(c)}" for c in columns if c not in keys)
    update = f"WHEN MATCHED THEN UPDATE SET {sets} " if sets else ""
    names = ", ".join(columns)
    values = ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {table} AS t USING {staging} AS s ON {same} {update}"
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def upsert_jdbc(
    options: Mapping[str, str],
    df: DataFrame,
    table: str,
    staging: str,
    keys: Sequence[str],
    run: Callable[[str], None],
    mode: str = "coalesce",
) -> None:
    """Merge df into a table by key: only its rows go to the staging table, then run merges them.

    run executes one statement on the database, over whatever connection the caller has.
    The table is neither read nor emptied; a failure before run leaves it as it was, and a
    repeated merge changes nothing.
    """
    write_jdbc(df, options, staging, "overwrite")
    run(merge_statement(table, staging, df.columns, keys, mode))


def publisher(
    options: Mapping[str, str],
    tables: Mapping[str, str],
    keys: Mapping[str, Sequence[str]] | None = None,
    run: Callable[[str], None] | None = None,
):
    """A publish callback for the jobs: copies stored results into database tables.

    tables names the table of each result that is wanted; keys the key columns of the
    results that are merged by key (see upsert_jdbc), whose staging table has the suffix
    _staging and whose statement goes to run.
    """

    def publish(name: str, df: DataFrame, mode: str) -> None:
        if name not in tables:
            return
        if mode == "upsert" or (keys and name in keys):
            if run is None or name not in (keys or {}):
                raise ValueError(f"{name} is merged by key: keys and run are needed")
            how = "replace" if mode == "upsert" else "coalesce"
            upsert_jdbc(options, df, tables[name], f"{tables[name]}_staging", keys[name], run, how)
        else:
            write_jdbc(df, options, tables[name], mode)

    return publish
