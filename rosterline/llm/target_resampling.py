"""Importance resampling towards a target text collection, on hashed word runs.

Words are found by an Aho-Corasick automaton whose entries are distinct words with a delimiter on
either side; an entry's payload is the CRC-32 and the byte length of its word, and a scan emits
one payload per word. Payloads of neighbouring words are composed to the CRC-32 of the run they
form (CRCs of joined strings follow from the CRCs and the length of the second), whose remainder
is the run's bucket. The automaton holds the most frequent words of a sample and of the target;
words it does not know stand between its matches and get their payload from their bytes, so the
buckets do not depend on which words it holds.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import picked, settings, small_table, staged

# The delimiters between words, after A-Z have become a-z; their pattern and byte table.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
# Documented bounds of the dictionary: so many entries of so many bytes, from so many sampled documents.
ENTRIES, LONGEST, SAMPLE = 32_768, 64, 20_000
# Bytes scanned together; a block ends where a word does.
BLOCK = 1 << 20
# Fixed value: the polynomial of CRC-32, lowest powers in the highest bits.
POLYNOMIAL = 0xEDB88320


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials modulo that of CRC-32, element by element."""
    a, b = np.broadcast_arrays(np.asarray(a, np.uint32), np.asarray(b, np.uint32))
    b, product = b.copy(), np.zeros(a.shape, np.uint32)
    for bit in range(31, -1, -1):
        product ^= np.where(a >> np.uint32(bit) & np.uint32(1), b, np.uint32(0))
        b = (b >> np.uint32(1)) ^ np.where(b & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return product


def composed(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRC-32 of joined strings from those of the first and the second and the second's byte length."""
    left, factor = np.asarray(length, np.int64), np.full(np.shape(length), 1 << 31, np.uint32)
    power = np.uint32(1 << 23)  # of one byte
    while left.any():
        factor = np.where(left & 1, _times(factor, power), factor)
        left, power = left >> 1, _times(power, power)
    return _times(first, factor) ^ np.asarray(second, np.uint32)


class Dictionary:
    """An automaton over delimiter-bounded words and their payloads."""

    def __init__(self, words: list[bytes]):
        self.crc = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.length = np.array([len(w) for w in words], np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, word in enumerate(words):
            self.automaton.add_word(f" {word.decode('latin-1')} ", i)
        if words:
            self.automaton.make_automaton()

    def _payloads(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(CRC-32, byte length) of the words of a block that begins and ends with a delimiter."""
        bare = np.frombuffer(data, np.uint8) == 32
        edges = np.flatnonzero(bare[1:] != bare[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        crc, length, known = np.zeros(len(starts), np.uint32), ends - starts, np.zeros(len(starts), bool)
        if len(self.crc):
            hits = np.array(list(self.automaton.iter(data.decode("latin-1"))), np.int64).reshape(-1, 2)
            at = np.searchsorted(ends, hits[:, 0])
            crc[at], length[at], known[at] = self.crc[hits[:, 1]], self.length[hits[:, 1]], True
        for i in np.flatnonzero(~known).tolist():
            crc[i] = zlib.crc32(data[starts[i] : ends[i]])
        return crc, length

    def features(self, text: str | None, n: int, buckets: int) -> tuple[int, np.ndarray]:
        """The number of words of a whole text, and the buckets of all runs of 1 to n of its words."""
        data = (text or "").encode("utf-8", "surrogatepass").translate(BYTES)
        parts, low = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))], 0
        while low < len(data):
            high = data.find(b" ", low + BLOCK)
            high = len(data) if high < 0 else high
            parts.append(self._payloads(b" " + data[low:high] + b" "))
            low = high
        crc, length = (np.concatenate(x) for x in zip(*parts, strict=True))
        found, run = [crc], crc
        for more in range(1, min(n, len(crc))):
            gap = np.full(len(crc) - more, zlib.crc32(b" "), np.uint32)
            run = composed(composed(run[:-1], gap, np.ones(len(gap), np.int64)), crc[more:], length[more:])
            found.append(run)
        return len(crc), np.concatenate(found) % np.uint32(buckets)


_DICTIONARIES: dict[str, Dictionary] = {}


def _dictionary(words: list[bytes], key: str) -> Dictionary:
    """One automaton per worker process."""
    if key not in _DICTIONARIES:
        _DICTIONARIES.clear()
        _DICTIONARIES[key] = Dictionary(words)
    return _DICTIONARIES[key]


def frequent_words(docs: DataFrame, target: DataFrame, id: str, text: str, target_text: str, entries: int) -> list[bytes]:
    """The most frequent words of the target and of a sample of about SAMPLE documents, at most LONGEST bytes each."""
    share = min(1.0, SAMPLE / max(1, docs.count()))
    place = F.shiftrightunsigned(F.xxhash64(F.col(f"`{id}`"), F.col(f"`{text}`")), 33)
    some = docs.filter(place <= int(share * (2**31 - 1))).select(F.col(f"`{text}`").alias("text"))
    both = some.union(target.select(F.col(f"`{target_text}`").alias("text"))).filter("text IS NOT NULL")
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), 0)
    counted = both.select(F.explode(words).alias("word")).filter(F.octet_length("word") <= LONGEST)
    counted = counted.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(entries)
    return sorted(r["word"].encode("utf-8", "surrogatepass") for r in counted.collect())


def features(docs: DataFrame, id: str, text: str, words: list[bytes], n: int, buckets: int) -> DataFrame:
    """(id, n_words, n_features, buckets): the buckets of each whole text, little-endian in one binary cell."""
    rows = picked(docs, *dict.fromkeys([id, text])).select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind, cell = rows.schema["id"].dataType.simpleString(), _cell(buckets)
    key = hashlib.sha256(b" ".join(words)).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _dictionary(words, key)
        for batch in batches:
            found = [known.features(t.as_py(), n, buckets) for t in batch.column("text")]
            table = [
                batch.column("id"), pa.array([w for w, _ in found], pa.int64()), pa.array([len(f) for _, f in found], pa.int64()),
                pa.array([f.astype(cell).tobytes() for _, f in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(table, ["id", "n_words", "n_features", "buckets"])

    return rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, buckets binary")


def _cell(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs over all rows: summed in tasks, then over tasks; at most `buckets` numbers come back."""
    cell = _cell(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for cells in batch.column("buckets"):
                total += np.bincount(np.frombuffer(cells.as_py(), cell), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "n"])

    total = np.zeros(buckets, np.int64)
    parts = found.select("buckets").mapInArrow(run, "bucket long, n long")
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] = r["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of each bucket, both smoothed by one."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    ratio = ((target + 1.0) * (s_all + buckets)) / ((source + 1.0) * (t_all + buckets))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def scored(found: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """(id, n_words, n_features, weight, score): the floored mean gain, and that with seeded Gumbel noise."""
    kind, cell = found.schema["id"].dataType.simpleString(), _cell(len(gain))
    rows = found.withColumn("name", F.coalesce(F.col("id").cast("string"), F.lit("")))

    def noise(name: str) -> int:
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = []
            for cells in batch.column("buckets"):
                at = np.frombuffer(cells.as_py(), cell)
                weight.append(int(gain[at].sum()) // len(at) if len(at) else 0)
            score = [w + noise(n.as_py()) for w, n in zip(weight, batch.column("name"), strict=True)]
            kept = [batch.column(c) for c in ("id", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(weight, pa.int64()), pa.array(score, pa.int64())], ["id", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long, score long")


def _ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """rows with their place in the order of scores, null beyond `drawn`.

    A distributed sort, written; a place is the rows of the parts before and the number in the part.
    """
    ordered = rows.orderBy(F.desc("score"), F.asc_nulls_last("id"), "n_features", "weight")
    ordered = staged(ordered.withColumn("place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("place", 33)
    sizes = sorted((r["part"], r["n"]) for r in ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = np.cumsum([0, *[n for _, n in sizes]])[:-1]
    begins = small_table(rows.sparkSession, part=pa.array([p for p, _ in sizes], pa.int64()), before=pa.array(before, pa.int64()))
    ranked = ordered.withColumn("part", part).join(F.broadcast(begins), "part")
    rank = F.col("before") + F.col("place").bitwiseAND(2**33 - 1) + 1
    return ranked.withColumn("rank", F.when(rank <= drawn, rank))


def resample(
    docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", target_text: str = "text", n: int = 1,
    buckets: int = 10_000, percent: int = 10, least: int = 20, seed: int = 2024, entries: int = ENTRIES,
) -> DataFrame:
    """A row per document: id, n_features, weight, score, rank (of those drawn, else null).

    Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII; features are all
    runs of 1 to n words, in buckets by CRC-32. A bucket gains the log of its share in the target
    over its share in all documents; weight is a document's mean gain, score adds Gumbel noise
    seeded by the id. Of the documents with at least `least` words `percent` in a hundred are
    drawn: those with the highest scores, ties to smaller ids (null ids last), which is sampling
    without replacement by weight.

    Null and empty texts have no features and weight 0; whole texts are read, very long ones in
    blocks; a null id takes the noise of an empty one; repeated rows are documents of their own,
    scored alike; other columns are ignored; an empty target gives gains by the documents alone;
    no documents give no rows. Every document and the whole target count; only the words the
    automaton holds come from a sample (ENTRIES, LONGEST, SAMPLE), and they change no result.
    The driver sees `buckets` counts and one count per score, whose range the noise bounds.
    """
    with settings(docs.sparkSession):
        words = frequent_words(docs, target, id, text, target_text, entries)
        found = staged(features(docs, id, text, words, n, buckets), "features")
        wanted = features(target, target_text, target_text, words, n, buckets)
        gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
        rows = staged(scored(found, gain, seed), "scored")
        long = F.col("n_words") >= least
        scores = sorted(((r["score"], r["n"]) for r in rows.filter(long).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
        drawn = percent * sum(k for _, k in scores) // 100
        reached = np.cumsum([0, *[k for _, k in scores]])
        lowest = next((s for (s, _), before in zip(reversed(scores), reversed(reached[:-1]), strict=True) if before < drawn), None)
        ahead = F.lit(False) if lowest is None else long & (F.col("score") >= lowest)
        ranked = _ranked(rows.filter(ahead), drawn)
    rest = rows.filter(~ahead).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("id").alias(id), "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).union(rest.select(*columns))
