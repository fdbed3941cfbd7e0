"""Token ids in binary shards with a minimal perfect hash index from document keys to offsets.

A shard is two files. `NAME.ids` holds raw little-endian unsigned ids, document after document, of
16 bits where all ids of the tokenizer fit, else of 32. `NAME.index` begins with MAGIC and a JSON header of the length given before it, then come
the arrays the header lists:

    bits, ranks    the perfect hash: one bit per cell of every level, set bits before each word
    fingerprints   of each slot the 32-bit fingerprint of its key
    first, copies  of each slot the first record with its key, and how many there are
    offsets        of each record the ids before it in the shard, and the number of all
    key_ends, key_text   of each slot's key, in key order, its text (a null key: an empty one and a flag)

The hash is made level by level: every key is hashed to a cell, cells with one key get a bit and
keep that key, the others go on to the next, smaller level. A key's slot is the number of set bits
before its own, so slots are numbered without gaps. Looking up a key takes one probe per level (two
on average), one comparison with the fingerprint and one read at the offset.

Files are written and read by the tasks through Arrow's file systems, in the folder that
spark.checkpoint.dir names. A task names its files after its attempt and returns their names with
what they hold; the table of these rows, which Spark commits, says which files count, so a task
that is run again, or twice at once, does no harm.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .packing import token_encoder
from .staging import picked, settings, staged

# Fixed value: the first bytes of an index file.
MAGIC = b"IDSHARD1"
# Cells per key of a level, and levels; the odds that a key is left after the last are nil.
SPARE, LEVELS = 2.0, 48
# Bytes of text to a shard, shards to a core where that gives more, bytes of ids read at a time.
SHARD_BYTES, PER_CORE, READ_BYTES = 128 << 20, 2, 8 << 20


def key_hashes(keys: list[str | None]) -> np.ndarray:
    """Two 64-bit hashes per key; a null key is no text that a key can be."""
    digests = b"".join(xxhash.xxh3_128_digest(b"\xff" if k is None else k.encode("utf-8", "surrogatepass")) for k in keys)
    return np.frombuffer(digests, "<u8").reshape(-1, 2)


def _cells(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    x = hashes[:, 0] + hashes[:, 1] * np.uint64(2 * level + 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(size)


@dataclass
class PerfectHash:
    """sizes: the cells of each level; bits: of all levels, in 64-bit words; ranks: set bits before each word."""

    sizes: list[int]
    bits: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray) -> PerfectHash:
        """For distinct keys given by their hashes."""
        sizes, words, left = [], [np.zeros(0, np.uint64)], hashes
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("two keys have the same 128-bit hash")
            size = -(-int(SPARE * len(left) + 1) // 64) * 64
            at = _cells(left, len(sizes), size).astype(np.int64)
            single = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(single, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~single[at]]
        bits = np.concatenate(words)
        return cls(sizes, bits, np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.uint64)[:-1]]).astype("<u8")[: len(bits)])

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each key; of a key that is not among those of the hash any slot, or -1."""
        found, left, before = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            at = _cells(hashes[left], level, size)
            word, bit = before + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            here = self.bits[word]
            hit = here >> bit & np.uint64(1) == 1
            below = here[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            found[left[hit]] = (self.ranks[word[hit]] + np.bitwise_count(below)).astype(np.int64)
            left, before = left[~hit], before + size // 64
        return found


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (hashes[:, 1] >> np.uint64(32)).astype("<u4")


def index_bytes(keys: list[str | None], lengths: list[int], kind: str = "<u4") -> bytes:
    """The index file of records in key order: equal keys stand together, a null one first. kind: of the ids."""
    distinct = [i for i, k in enumerate(keys) if not i or k != keys[i - 1]]
    names = [keys[i] for i in distinct]
    hashes = key_hashes(names)
    known = PerfectHash.of(hashes)
    slots = known.slots(hashes)
    first, copies, prints = np.zeros(len(names), "<u8"), np.zeros(len(names), "<u8"), np.zeros(len(names), "<u4")
    first[slots], copies[slots], prints[slots] = distinct, np.diff([*distinct, len(keys)]), _fingerprints(hashes)
    texts = [(k or "").encode("utf-8", "surrogatepass") for k in names]
    arrays = {
        "bits": known.bits, "ranks": known.ranks, "fingerprints": prints, "first": first, "copies": copies,
        "offsets": np.cumsum([0, *lengths]).astype("<u8"), "key_ends": np.cumsum([len(t) for t in texts]).astype("<u8"),
        "key_text": np.frombuffer(b"".join(texts), np.uint8),
    }
    head = {"ids": kind, "sizes": known.sizes, "null_key": bool(names) and names[0] is None, "arrays": [[n, a.dtype.str, len(a)] for n, a in arrays.items()]}
    said = json.dumps(head).encode()
    return b"".join([MAGIC, len(said).to_bytes(8, "little"), said, *[a.tobytes() for a in arrays.values()]])


@dataclass
class Shard:
    """An open shard; keys are texts."""

    folder: str
    name: str
    _ids: pa.NativeFile = field(init=False, repr=False)

    def __post_init__(self):
        files, path = _files(self.folder)
        with files.open_input_file(f"{path}/{self.name}.index") as f:
            data = f.read()
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{self.name} is no index file")
        at = len(MAGIC) + 8
        said = int.from_bytes(data[len(MAGIC) : at], "little")
        head, at = json.loads(data[at : at + said]), at + said
        held = {}
        for name, kind, count in head["arrays"]:
            held[name] = np.frombuffer(data, kind, count, at)
            at += held[name].nbytes
        self._kind = np.dtype(head["ids"])
        self._hash = PerfectHash(head["sizes"], held["bits"], held["ranks"])
        self._prints, self._first, self._copies, self._offsets = (held[n] for n in ("fingerprints", "first", "copies", "offsets"))
        self._ends, self._text, self._null = held["key_ends"], held["key_text"], head["null_key"]
        self._ids = files.open_input_file(f"{path}/{self.name}.ids")

    def __enter__(self) -> Shard:
        return self

    def __exit__(self, *_) -> None:
        self._ids.close()

    def find(self, keys: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(first record, number of records) of each key; a key the shard has not: none (but for one in 2**32)."""
        hashes = key_hashes(keys)
        slots = self._hash.slots(hashes)
        known = slots >= 0
        known[known] = self._prints[slots[known]] == _fingerprints(hashes[known])
        first, copies = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[known], copies[known] = self._first[slots[known]], self._copies[slots[known]]
        return first, copies

    def get(self, key: str | None) -> list[np.ndarray]:
        """The ids of each document with that key."""
        (first,), (copies,) = self.find([key])
        return [self._read(*self._offsets[i : i + 2].tolist()) for i in range(first, first + copies)]

    def _read(self, low: int, high: int) -> np.ndarray:
        wide = self._kind.itemsize
        return np.frombuffer(self._ids.read_at(wide * (high - low), wide * low), self._kind).astype("<u4")

    def keys(self) -> Iterator[str | None]:
        text, last = self._text.tobytes(), 0
        for i, end in enumerate(self._ends.tolist()):
            yield None if self._null and not i else text[last:end].decode("utf-8", "surrogatepass")
            last = end

    def records(self) -> Iterator[tuple[str | None, int, np.ndarray]]:
        """(key, ids before it in the shard, ids) of every record, found by its key, in file order."""
        keys = list(self.keys())
        first, copies = self.find(keys)
        held_from, held = 0, np.zeros(0, "<u4")
        for key, low, number in zip(keys, first.tolist(), copies.tolist(), strict=True):
            for i in range(low, low + number):
                start, end = self._offsets[i : i + 2].tolist()
                if not held_from <= start <= end <= held_from + len(held):  # the next block, or one long record
                    held_from, held = start, self._read(start, max(end, min(start + READ_BYTES // 4, int(self._offsets[-1]))))
                yield key, start, held[start - held_from : end - held_from]


def _files(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


@dataclass
class Shards:
    """Written shards: the folder, and the table of their files (shard, name, records, ids, first_key, last_key, start)."""

    folder: str
    table: DataFrame

    def get(self, key: str | None) -> list[np.ndarray]:
        """The ids of each document with that key: the shards whose keys reach from before to after it are asked."""
        kind = self.table.schema["first_key"].dataType.simpleString()
        wanted = F.lit(key).cast(kind)
        inside = F.col("first_key").isNull() if key is None else (F.coalesce(F.col("first_key") <= wanted, F.lit(True)) & (F.col("last_key") >= wanted))
        found = []
        for row in self.table.filter(inside).orderBy("shard").collect():
            with Shard(self.folder, row["name"]) as shard:
                found += shard.get(key)
        return found


def write(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", end: int = 0, shard_bytes: int = SHARD_BYTES
) -> Shards:
    """Encode every text, append the id `end`, and write shards in ascending id order.

    Texts are dealt to shards by ranges of (id, hash of the text), so neither an id of very many
    rows nor one text in very many rows need be in one shard. Null ids come first.
    """
    spark = docs.sparkSession
    folder = f"{scratch_path(spark, 'ids')}-{uuid.uuid4().hex[:8]}"
    rows = picked(docs, *dict.fromkeys([id, text])).select(
        F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()
    source = spark.sparkContext.broadcast(open(tokenizer, encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard, name = task.partitionId(), f"{task.partitionId():08d}-{task.taskAttemptId()}"
        files, path = _files(folder)
        keys, lengths, ends = [], [], [None, None]
        first = next(batches, None)
        while first is not None and not len(first):
            first = next(batches, None)
        if first is None:
            return
        files.create_dir(path, recursive=True)
        encoder = token_encoder(source.value)
        width = "<u2" if max(encoder.largest, end) < 1 << 16 else "<u4"
        with files.open_output_stream(f"{path}/{name}.ids") as out:
            batch, ends[0] = first, first.column("id")[0]
            while batch is not None:
                if len(batch):
                    ends[1] = batch.column("id")[len(batch) - 1]
                for key, said in zip(batch.column("key"), batch.column("text"), strict=True):
                    ids = np.append(encoder.ids(said.as_py()), np.uint32(end)).astype(width)
                    out.write(ids.tobytes())
                    keys.append(key.as_py())
                    lengths.append(len(ids))
                batch = next(batches, None)
        with files.open_output_stream(f"{path}/{name}.index") as out:
            out.write(index_bytes(keys, lengths, width))
        columns = [pa.array([shard]), pa.array([name]), pa.array([len(keys)]), pa.array([sum(lengths)])]
        yield pa.RecordBatch.from_arrays(
            [*columns, *[pa.array([e.as_py()], first.schema.field("id").type) for e in ends]],
            ["shard", "name", "records", "ids", "first_key", "last_key"],
        )

    with settings(spark):
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(1, -(-size // shard_bytes), PER_CORE * spark.sparkContext.defaultParallelism)
        rows = rows.withColumn("mark", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
        order = [F.asc_nulls_first("id"), F.asc("mark"), F.asc("row")]
        dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        made = dealt.select("id", F.col("id").cast("string").alias("key"), "text").mapInArrow(
            run, f"shard long, name string, records long, ids long, first_key {kind}, last_key {kind}"
        )
        table = staged(made, "shards")
    return _placed(folder, table)


def _placed(folder: str, table: DataFrame) -> Shards:
    """With the ids before each shard; the table has a row per shard, not per document."""
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return Shards(folder, table.withColumn("start", F.coalesce(F.sum("ids").over(ahead), F.lit(0))))


def read(shards: Shards, id: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files."""
    kind, folder, table = shards.table.schema["first_key"].dataType.simpleString(), shards.folder, shards.table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist(), strict=True):
                keys, starts, sizes, sums = [], [], [], []
                with Shard(folder, name) as shard:
                    for key, start, ids in shard.records():
                        keys.append(key)
                        starts.append(before + start)
                        sizes.append(len(ids))
                        sums.append(zlib.crc32(ids))
                columns = [pa.array(keys, pa.string()), *[pa.array(c, pa.int64()) for c in (starts, sizes, sums)]]
                yield pa.RecordBatch.from_arrays(columns, ["key", "start", "n_tokens", "ids_crc32"])

    # a shard to a task: the rows are few and stand in few files
    dealt = table.select("name", "start").repartition(max(1, table.count()))
    found = dealt.mapInArrow(run, "key string, start long, n_tokens long, ids_crc32 long")
    return found.select(F.col("key").cast(kind).alias(id), "start", "n_tokens", "ids_crc32")


def encoded(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", end: int = 0, **limits) -> DataFrame:
    """`write` and then `read`: a row per document with id, start, n_tokens and ids_crc32.

    start counts the ids of all documents before it in ascending id order, n_tokens the document's
    own with `end`, ids_crc32 is the CRC-32 of these as little-endian unsigned 32-bit integers. A
    null text counts as empty, an empty one has `end` only; whole texts are encoded, strings of
    special tokens as those. Null ids come first; rows that repeat an id are records of their own
    under one key, in the order of their texts' hashes; other columns are ignored; an empty table
    gives no files and no rows. Ids are of a type whose text form can be read back.
    """
    return read(write(docs, tokenizer, id, text, end, **limits), id)


def open_shards(spark: SparkSession, folder: str, table: str) -> Shards:
    """Shards of an earlier run, from their folder and the path of their table."""
    return _placed(folder, spark.read.parquet(table))
