"""Packing by minimum bin slack: token windows filled from the multiset of remaining lengths."""

from __future__ import annotations

import contextlib
import functools
import json
import math
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import picked, settings, small_table, staged

# Fixed value: how byte-level BPE of the provided vocabulary splits a text before merging.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Pieces of a length are ranked in groups, as many as the root of all pieces divided by this;
# ranks go on from one group to the next. So neither the groups nor their pieces grow like the
# input, and no task ranks all pieces of a frequent length.
GROUP_SCALE = 4


class Encoder:
    """Token ids of a byte-level BPE given as the JSON of a tokenizers file.

    Where the file is plain byte-level BPE with merges in the order of their ids, texts are
    encoded by tiktoken, which gives the same ids several times faster; else by tokenizers, and so
    are texts that tiktoken refuses, for it fails on white space of many thousand characters.
    With `special`, strings of special tokens get their own ids, as is the default of
    tokenizers; without, they are ordinary text.
    """

    def __init__(self, source: str, special: bool = False):
        model = json.loads(source)
        self.plain, self.source, self.special = None, source, special
        self.largest = max([*model["model"]["vocab"].values(), *[t["id"] for t in model["added_tokens"]]])
        if self._is_plain(model):
            import tiktoken

            chars = _byte_chars()
            ranks = {bytes(chars[c] for c in token): i for token, i in model["model"]["vocab"].items() if all(c in chars for c in token)}
            added = {t["content"]: t["id"] for t in model["added_tokens"]}
            strings = {t.encode() for t in added}
            ranks = {token: i for token, i in ranks.items() if token not in strings}
            self.plain = tiktoken.Encoding("given", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens=added if special else {})

    @functools.cached_property
    def other(self):
        from tokenizers import Tokenizer

        known = Tokenizer.from_str(self.source)
        known.encode_special_tokens = not self.special
        return known

    @staticmethod
    def _is_plain(model: dict) -> bool:
        step, bpe = model.get("pre_tokenizer") or {}, model["model"]
        if model.get("normalizer") or step.get("type") != "ByteLevel" or step.get("add_prefix_space") or not step.get("use_regex", True):
            return False
        if bpe.get("type") != "BPE" or any(bpe.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges")):
            return False
        added = [t["content"] for t in model["added_tokens"]]
        if any(t.get(k) for t in model["added_tokens"] for k in ("lstrip", "rstrip", "single_word")) or any(a != b and a in b for a in added for b in added):
            return False
        pairs = (m if isinstance(m, list) else m.split(" ") for m in bpe["merges"])
        made = [bpe["vocab"]["".join(p)] for p in pairs]
        return all(a < b for a, b in zip(made, made[1:], strict=False))

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if self.plain:
            with contextlib.suppress(ValueError):  # its pattern fails on very long white space
                return self.plain.encode_to_numpy(text, allowed_special="all", disallowed_special=())
        return np.array(self.other.encode(text, add_special_tokens=False).ids, np.uint32)


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in shown}
    chars |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return chars


_ENCODERS: dict[int, Encoder] = {}


def token_encoder(source: str) -> Encoder:
    """One encoder per worker process."""
    known = hash(source)
    if known not in _ENCODERS:
        _ENCODERS[known] = Encoder(source, special=True)
    return _ENCODERS[known]


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


# --- which pieces go together -------------------------------------------------------


def best_fill(counts: np.ndarray, room: int) -> dict[int, int]:
    """How many pieces of which length fill `room` with the least slack.

    Subset-sum over a bitset: bit s of `reach` says that some pieces sum to s. Lengths are
    taken from the largest; the bitset before each is kept, so that the counts can be read
    back from the best sum. It stops as soon as the room can be filled exactly.
    """
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in range(min(room, len(counts) - 1), 0, -1):
        left = min(int(counts[length]), room // length)
        if not left:
            continue
        before, take = reach, 1
        while left:
            take = min(take, left)
            reach |= reach << (take * length) & full
            left -= take
            take *= 2
        steps.append((length, before))
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> (total - n * length) & 1:
            n += 1
        if n:
            used[length] = n
            total -= n * length
    return used


class _Runs:
    """Pieces by length, as runs of ranks: (class, first rank, count, tokens already used)."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.astype(np.int64).copy()
        self.runs = [deque([(n, 0, int(c), 0)] if c else []) for n, c in enumerate(counts)]

    def draw(self, length: int, number: int) -> list[tuple[int, int, int, int]]:
        """Take so many pieces of a length."""
        self.counts[length] -= number
        found, queue = [], self.runs[length]
        while number:
            kind, first, count, used = queue.popleft()
            take = min(number, count)
            if take < count:
                queue.appendleft((kind, first + take, count - take, used))
            found.append((kind, first, take, used))
            number -= take
        return found

    def back(self, runs: list[tuple[int, int, int, int]], spent: int) -> None:
        """Put pieces back of which the first `spent` tokens have gone."""
        for kind, first, count, used in runs:
            length = kind - used - spent
            if length:
                self.counts[length] += count
                self.runs[length].append((kind, first, count, used + spent))


def plan(counts: np.ndarray, capacity: int) -> tuple[list[tuple], int]:
    """Rules that place all pieces, and the number of sequences.

    counts[n]: pieces of n tokens (n = capacity: whole windows). A rule (class, first rank,
    past rank, used, length, sequence, each, position, offset) places `length` tokens, after
    `used`, of the pieces of a class with such ranks: the i-th goes to sequence + (position
    + i) div each, at offset + (position + i) mod each * length.

    A window takes the longest piece left and the pieces that leave the least slack. The same
    filling is repeated as often as its lengths last, so the work depends on the capacity and
    not on the number of pieces. Slack that nothing fits is filled by cutting the shortest
    piece left. What is left when less than a window remains is cut into sequences whose
    lengths are powers of two.
    """
    pieces, rules, sequences = _Runs(counts), [], 0

    def place(length: int, each: int, times: int, offset: int, cut_from: int | None = None) -> None:
        runs, position = pieces.draw(cut_from or length, each * times), 0
        for kind, first, count, used in runs:
            rules.append((kind, first, first + count, used, length, sequences, each, position, offset))
            position += count
        if cut_from:
            pieces.back(runs, length)

    lengths = np.arange(len(counts))
    total = int((pieces.counts * lengths).sum())
    while total >= capacity:
        longest = int(np.flatnonzero(pieces.counts)[-1])
        rest = pieces.counts.copy()
        rest[longest] -= 1
        used = best_fill(rest, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        slack = capacity - sum(n * k for n, k in used.items())
        times = min(int(pieces.counts[n]) // k for n, k in used.items())
        cut = None
        if slack:
            after = pieces.counts.copy()
            for n, k in used.items():
                after[n] -= k
            cut = int(np.flatnonzero(after[: capacity + 1])[0])
            times = min(int(pieces.counts[n]) // (k + (n == cut)) for n, k in (used | {cut: used.get(cut, 0)}).items())
        offset = 0
        for n, k in sorted(used.items(), reverse=True):
            place(n, k, times, offset)
            offset += n * k
        if cut:
            place(slack, 1, times, offset, cut_from=cut)
        sequences += times
        total -= capacity * times
    room = at = 0
    while total:
        if not room:
            room, at = 1 << (total.bit_length() - 1), 0
        longest = int(np.flatnonzero(pieces.counts)[-1])
        take = min(longest, room)
        place(take, 1, 1, at, cut_from=longest if take < longest else None)
        total, room, at = total - take, room - take, at + take
        sequences += not room
    return rules, sequences


# --- the job ------------------------------------------------------------------------


def pieces(docs: DataFrame, tokenizer: str, id: str, text: str, capacity: int, end: int) -> DataFrame:
    """(id, mark, doc_tokens, start, length, ids_crc32, ids): each text cut into windows and a rest.

    Only a rest, which may be cut again, has its ids, as little-endian unsigned 32-bit integers.
    """
    source = docs.sparkSession.sparkContext.broadcast(open(tokenizer, encoding="utf-8").read())
    rows = picked(docs, *dict.fromkeys([id, text])).select(
        F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )

    @F.arrow_udf("array<struct<doc_tokens: long, start: long, length: long, ids_crc32: long, ids: binary>>")
    def cut(texts: pa.Array) -> pa.Array:
        encode, ends, rests = token_encoder(source.value).ids, [0], []
        total, start, length, crc = [], [], [], []
        for text in texts:
            ids = np.append(encode(text.as_py()), np.uint32(end)).astype("<u4")
            for low in range(0, len(ids), capacity):
                part = ids[low : low + capacity]
                total.append(len(ids))
                start.append(low)
                length.append(len(part))
                crc.append(crc32(part))
                rests.append(part.tobytes() if len(part) < capacity else None)
            ends.append(len(total))
        cells = [*[pa.array(v, pa.int64()) for v in (total, start, length, crc)], pa.array(rests, pa.binary())]
        found = pa.StructArray.from_arrays(cells, ["doc_tokens", "start", "length", "ids_crc32", "ids"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)

    return rows.select("id", F.xxhash64("text").alias("mark"), F.explode(cut("text")).alias("piece")).select("id", "mark", "piece.*")


def pack(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = 1024, end: int = 0
) -> DataFrame:
    """A row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its whole text, strings of special tokens as those, and then `end`
    (a null text: only that). Its whole
    windows are sequences of their own; the rests are packed by `plan` from the number of
    pieces of each length, which is all that the driver sees: at most `capacity` numbers.
    Pieces of a length are ranked in groups, so no task ranks all of a frequent length, and the
    rules, a few per length, are broadcast. Every text is encoded once: the rests are stored with
    their ids, and those that the plan cuts meet them by the number of their row, so no texts are
    joined. Every sequence is full, but for at most log2(capacity) whose lengths are powers of two.

    Null ids are ids like others; repeated rows are separate documents; other columns are
    ignored; an empty table gives no rows.
    """
    if capacity < 2 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    spark = docs.sparkSession
    with settings(spark):
        cut = pieces(docs, tokenizer, id, text, capacity, end).withColumn("row", F.monotonically_increasing_id())
        cut = staged(cut, "pieces")
        sizes = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
        counts = np.zeros(capacity + 1, np.int64)
        for length, n in sizes.items():
            counts[length] = n
        rules, _ = plan(counts, capacity)
        groups = max(1, math.isqrt(int(counts.sum())) // GROUP_SCALE)
        rows = cut.drop("ids").withColumn("_group", F.pmod(F.xxhash64("id", "mark", "start"), F.lit(groups)))
        ahead = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
        begin = rows.groupBy("length", "_group").agg(F.count("*").alias("_n"))
        begin = begin.withColumn("_begin", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
        order = Window.partitionBy("length", "_group").orderBy("id", "mark", "start", "row")
        ranked = rows.withColumn("_rank", F.row_number().over(order) - 1).join(begin, ["length", "_group"])
        ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_begin")).withColumnRenamed("length", "_kind")
        names = "kind low high used length sequence each position offset".split()
        columns = zip(*rules, strict=True) if rules else [()] * len(names)
        table = small_table(spark, **{n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})
        joined = ranked.join(F.broadcast(table), (F.col("_kind") == F.col("kind")) & F.expr("_rank >= low AND _rank < high"))
        nth = F.col("position") + F.col("_rank") - F.col("low")
        placed = joined.select(
            "id", (F.col("start") + F.col("used")).alias("start"), "length", F.when(F.col("length") == F.col("_kind"), F.col("ids_crc32")).alias("ids_crc32"),
            "doc_tokens", (F.col("sequence") + F.expr("(position + _rank - low) div each")).alias("sequence_id"),
            (F.col("offset") + nth % F.col("each") * F.col("length")).alias("offset"), "used", "row",
        )
        placed = staged(placed, "placed")
        parts = staged(placed.filter("ids_crc32 IS NULL").drop("ids_crc32"), "parts")
    # Spark sees how large the written parts are, and sends them to all tasks or deals out both sides
    met = parts.join(cut.select("row", "ids").filter("ids IS NOT NULL"), "row")
    met = met.withColumn("ids_crc32", F.crc32(F.expr("substring(ids, cast(4 * used + 1 as int), cast(4 * length as int))")))
    columns = [F.col("id").alias(id), *map(F.col, "start length ids_crc32 doc_tokens sequence_id offset".split())]
    return placed.filter("ids_crc32 IS NOT NULL").select(*columns).union(met.select(*columns))
