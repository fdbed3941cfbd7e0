"""The strike stream: flagged messages to strike counts and reduced salaries.

State lies under one root. Strike rows and flags are layered tables (`sources.layers`): a
micro-batch writes one layer of each under its own name, so a batch that is replayed after a
failure replaces its first attempt; what it reads leaves out its own earlier layer. It opens the
parts and layers that can have its senders, by path, and lists nothing, so its cost follows the
batch and neither the store nor its age. Each step is computed from the rows the step before
wrote, never from a plan that would be evaluated again.

    layout                         block, limit and days of this root
    flags/, strikes/               layered tables: flagged messages, and strike rows by batch or salary sync
    synced                         up to which commit of the periods the last salary sync has read
    struck_out/block=B/origin=...  employees who reached the limit
    struck_base/version=V          struck-out employees, all batches before V folded

A block is a number of batches: so many layers lie over a base before they are folded into it, and
parts that outgrow a size are split then.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..functions.columns import moment
from ..operators.merge import changed_rows
from ..operators.messages import Words, decode, flag, word_values
from ..operators.strikes import count_flags, recent, score, struck_out
from ..schemas import FLAG_DAYS, FLAGGED, MAX_STRIKES, STRIKE_FACTOR, STRUCK_OUT, strikes
from ..sources import layers
from ..sources.commits import Commit, read_text, write_text
from ..sources.files import child_names, empty_frame, path_exists, remove
from ..sources.versions import latest, read_latest, retire_versions, versions, write_next

# Batches per block, unless a root was made with another number.
BLOCK = 100
# Layers are folded by their number; before that only where they hold so many times a part's rows.
SHARE = 4.0
ORIGIN = StructField("origin", StringType(), True)


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass
class StrikeStream:
    """Settings of the stream; clock is read once per batch.

    The first batch stores block, limit and days under the root; later they must be the
    same. A word list given inline is fetched when the settings are made and stays as it
    was; one that is not is read again in every batch.
    """

    root: str
    marked: Words
    vocab: Words
    limit: int = MAX_STRIKES
    factor: str = STRIKE_FACTOR
    days: int = FLAG_DAYS
    mode: str = "recompute"
    exact: bool = False
    fold: str = "upper"
    block: int = BLOCK
    inline_marked: bool = True
    inline_vocab: bool = False
    clock: Callable[[], dt.datetime] = _utc_now
    # Called with (changed strike rows, batch id) after the batch is stored, for
    # example to upsert them into a database.
    on_changes: Callable[[DataFrame, int], None] | None = field(default=None)
    # Called with (ids struck out in the batch, batch id), for example to set their
    # periods to INACTIVE in a database; the stored periods follow in the daily run.
    on_struck: Callable[[DataFrame, int], None] | None = field(default=None)

    def __post_init__(self) -> None:
        if self.inline_marked:
            self.marked = word_values(self.marked)
        if self.inline_vocab:
            self.vocab = word_values(self.vocab)


@dataclass(frozen=True)
class Layout:
    """What all readers and writers of a root must agree on."""

    block: int = BLOCK
    limit: int = MAX_STRIKES
    days: int = FLAG_DAYS


def layout(
    spark: SparkSession,
    root: str,
    block: int | None = None,
    limit: int | None = None,
    days: int | None = None,
    create: bool = False,
) -> Layout:
    """The stored layout of a root, or the given or default one where none is stored yet.

    A value that differs from the stored one is refused. create stores a new layout.
    """
    path = f"{root}/layout"
    wanted = {"block": block, "limit": limit, "days": days}
    given = {k: v for k, v in wanted.items() if v is not None}
    if path_exists(spark, f"{path}/_SUCCESS"):
        row = spark.read.schema("block int, limit int, days int").parquet(path).first()
        known = Layout(**row.asDict())
    else:
        known = Layout(**given)
        if create:
            row = [(known.block, known.limit, known.days)]
            made = spark.createDataFrame(row, "block int, limit int, days int")
            made.coalesce(1).write.mode("overwrite").parquet(path)
    for name, value in given.items():
        if value != getattr(known, name):
            raise ValueError(f"{root} was made with {name}={getattr(known, name)}, not {value}")
    return known


def strike_log_schema(limit: int) -> StructType:
    return StructType([*strikes(limit).fields, StructField("changed_at", TimestampType(), True)])


def _origin(batch_id: int) -> str:
    return f"stream-{batch_id:020d}"


def _block_name(number: int) -> str:
    return f"block={number:012d}"


def _blocks(spark: SparkSession, path: str) -> list[str]:
    return sorted(n for n in child_names(spark, path) if n.startswith("block="))


def _read_blocks(spark: SparkSession, path: str, schema: StructType, first: int = 0) -> DataFrame:
    """The rows of the blocks from the given number on, with their origin."""
    full = StructType([*schema.fields, ORIGIN])
    wanted = [f"{path}/{name}" for name in _blocks(spark, path) if name >= _block_name(first)]
    if not wanted:
        return empty_frame(spark, full)
    typed = StructType([*full.fields, StructField("block", StringType(), True)])
    return spark.read.schema(typed).option("basePath", path).parquet(*wanted).drop("block")


def strike_rows(spark: SparkSession, root: str, made: Layout) -> layers.Table:
    """The strike rows, replaced by employee."""
    return layers.Table(spark, f"{root}/strikes", strike_log_schema(made.limit), "employee_id", layers=made.block, share=SHARE)


def flag_rows(spark: SparkSession, root: str, made: Layout) -> layers.Table:
    """The flags, a log."""
    return layers.Table(spark, f"{root}/flags", FLAGGED, "employee_id", replaces=False, layers=made.block, share=SHARE)


def strike_table(
    spark: SparkSession,
    root: str,
    limit: int | None = None,
    block: int | None = None,
    without: str | None = None,
) -> DataFrame:
    """The current strike table, or what it was without one origin."""
    made = layout(spark, root, block=block, limit=limit)
    return strike_rows(spark, root, made).read(without=without).select(*strikes(made.limit).fieldNames())


def flag_log(spark: SparkSession, root: str, block: int | None = None) -> DataFrame:
    """Stored flags: those that folds have kept, and what came after."""
    return flag_rows(spark, root, layout(spark, root, block=block)).read()


def struck_out_table(spark: SparkSession, root: str) -> DataFrame:
    """Everybody struck out so far."""
    folded = latest(spark, f"{root}/struck_base")
    first = (folded or 0) // layout(spark, root).block
    newer = _read_blocks(spark, f"{root}/struck_out", STRUCK_OUT, first)
    base = read_latest(spark, f"{root}/struck_base", STRUCK_OUT)
    return base.select("employee_id").union(newer.select("employee_id")).distinct()


def sync_origin(asof: dt.datetime) -> str:
    """The origin of the salary sync of a moment; it sorts after those of batches."""
    return f"sync-{asof:%Y-%m-%dT%H%M%S.%f}"


def store_salaries(
    rows: DataFrame | Callable[[DataFrame], DataFrame], root: str, asof: dt.datetime, limit: int | None = None
) -> DataFrame:
    """Write the strike rows of a salary sync and return them as stored.

    Rows given as a function are computed from the strike table without this origin, again if a
    batch comes in between; so repeating a sync replaces it, and it loses no count. A row is not
    stamped earlier than the one it follows.
    """
    spark = rows.sparkSession if isinstance(rows, DataFrame) else SparkSession.active()
    origin, made = sync_origin(asof), layout(spark, root, limit=limit)
    table = strike_rows(spark, root, made)

    def stamped(at: Commit) -> DataFrame:
        known = table.read(at, without=origin)
        new = rows if isinstance(rows, DataFrame) else rows(known.select(*strikes(made.limit).fieldNames()))
        seen = known.select(F.col("employee_id").alias("seen_id"), F.col("changed_at").alias("seen_at"))
        joined = new.join(seen, F.col("employee_id") == F.col("seen_id"), "left")
        return joined.withColumn("changed_at", F.greatest(moment(asof), "seen_at"))

    return table.write(stamped, origin=origin).drop("changed_at")


def synced(spark: SparkSession, root: str, asof: dt.datetime) -> int | None:
    """Up to which commit of the periods syncs before this one have read; None before the first."""
    path = f"{root}/synced"
    if not path_exists(spark, path):
        return None
    last = json.loads(read_text(spark, path))
    return last["since"] if last["origin"] == sync_origin(asof) else last["upto"]


def note_synced(spark: SparkSession, root: str, asof: dt.datetime, since: int | None, upto: int) -> None:
    """Remember it; with where it began, so that a repeated sync reads the same changes again."""
    write_text(spark, f"{root}/synced", json.dumps({"origin": sync_origin(asof), "since": since, "upto": upto}))


def fold_block(spark: SparkSession, job: StrikeStream, batch_id: int, now: dt.datetime) -> None:
    """Fold what is due before a batch; layers of a batch that is replayed wait for the next."""
    made, origin = Layout(job.block, job.limit, job.days), _origin(batch_id)
    flags = flag_rows(spark, job.root, made)
    if all(x["origin"] != origin for x in flags.head().state.get("layers", [])):
        strike_rows(spark, job.root, made).fold()
        flags.fold(keep=lambda rows: recent(rows, now, job.days))
    if batch_id and batch_id % job.block == 0 and batch_id not in versions(spark, f"{job.root}/struck_base"):
        write_next(struck_out_table(spark, job.root), f"{job.root}/struck_base", number=batch_id)


def retire(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove folded state: what none of the newest `keep` commits or versions needs."""
    made = layout(spark, root)
    for table in (strike_rows(spark, root, made), flag_rows(spark, root, made)):
        table.retire(keep)
    retire_versions(spark, f"{root}/struck_base", keep)
    left = versions(spark, f"{root}/struck_base")
    for name in _blocks(spark, f"{root}/struck_out"):
        if left and name < _block_name(left[0] // made.block):
            remove(spark, f"{root}/struck_out/{name}")


def strike_batch(batch: DataFrame, batch_id: int, job: StrikeStream) -> None:
    """One micro-batch of JSON messages."""
    spark, root = batch.sparkSession, job.root
    now = job.clock()
    made = layout(spark, root, job.block, job.limit, job.days, create=True)
    block, origin = batch_id // job.block, _origin(batch_id)
    fold_block(spark, job, batch_id, now)
    found = flag(
        decode(batch), job.marked, job.vocab, now, fold=job.fold,
        inline_marked=job.inline_marked, inline_vocab=job.inline_vocab,
    )
    flags, table = flag_rows(spark, root, made), strike_rows(spark, root, made)
    arrived = flags.write(lambda _: found, origin=origin)
    slots = flags.slots_of(origin)
    if not slots:
        return

    def scored(at: Commit) -> DataFrame:
        counts = count_flags(flags.read(slots=slots, without=origin), arrived, now, job.days)
        known = table.read(at, slots, without=origin).select(*strikes(job.limit).fieldNames())
        old = known.join(arrived.select("employee_id"), "employee_id", "left_semi")
        new = score(old, counts, job.limit, job.factor, job.mode, job.exact)
        return changed_rows(old, new, ["employee_id"]).withColumn("changed_at", moment(now))

    changed = table.write(scored, origin=origin, reads=slots)
    path = f"{root}/struck_out/{_block_name(block)}/origin={origin}"
    struck_out(changed, job.limit, exact=job.exact).select("employee_id").write.mode("overwrite").parquet(path)
    gone = spark.read.schema(STRUCK_OUT).parquet(path)
    if job.on_changes:
        job.on_changes(changed.drop("changed_at"), batch_id)
    if job.on_struck:
        job.on_struck(gone, batch_id)


def start(
    messages: DataFrame,
    job: StrikeStream,
    checkpoint: str,
    every: str | None = "30 seconds",
):
    """Start the stream; every=None processes what is available and stops."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        messages.writeStream.foreachBatch(lambda df, k: strike_batch(df, k, job))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
