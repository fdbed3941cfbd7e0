"""Quality by compression: how well dictionaries of good and of bad text compress a document."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import Logistic, chosen, fold, prior_weights
from .staging import settings, staged

# Bytes compressed at a time. A dictionary only helps at the start of what is compressed, so
# every text is compressed whole, piece by piece, and all pieces count.
PIECE = 512
LEVEL = 3


def _pieces(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)] or [b""]


@functools.lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def _features(text: str | None, good: bytes, bad: bytes) -> tuple[float, float, float]:
    """Of a text's compressed sizes: their normalised difference, its least value for any
    piece, and the bytes left of each byte."""
    pieces = _pieces(text)
    by_good, by_bad = _compressor(good).compress, _compressor(bad).compress
    g = np.fromiter((len(by_good(p)) for p in pieces), float, len(pieces))
    b = np.fromiter((len(by_bad(p)) for p in pieces), float, len(pieces))
    length = sum(map(len, pieces))
    apart = (b - g) / (b + g)
    return (b.sum() - g.sum()) / (b.sum() + g.sum()), apart.min(), np.log(min(g.sum(), b.sum()) / (length + 16))


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    calibration: Logistic

    def scores(self, texts) -> np.ndarray:
        if len(texts) == 0:
            return np.zeros(0)
        return self.calibration.score(np.array([_features(t, self.good, self.bad) for t in texts]))


def _dictionary(pieces: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:  # too few pieces to train on: their bytes are the dictionary
        return b"".join(pieces)[-size:]


def spread(pieces: list[bytes], most: int) -> list[bytes]:
    """At most so many pieces, evenly from all over the text."""
    return pieces if len(pieces) <= most else [pieces[i * len(pieces) // most] for i in range(most)]


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
    kept: Column | None = None, rows: int = 2000, pieces: int = 40, size: int = 65_536,
) -> tuple[QualityModel | None, float]:
    """The model, None if a label is missing in one of its parts, and label 1's share among the labels that may be learned.

    Fitted on at most `rows` labelled documents per label (a documented bound, see
    `labelled.chosen`; the share is counted over all labels), of any length. Two thirds, by a hash
    of the id, make the dictionaries: at most `pieces` pieces of each text, from all over it, come
    to the driver. The other third makes the calibration: their whole texts are compressed in
    tasks, and three numbers of each come back.
    """
    kept = F.lit(True) if kept is None else kept
    found, share = chosen(docs, labels, id, text, label, kept, rows)
    if found is None:
        return None, share
    found = staged(found.withColumn("third", F.pmod(F.xxhash64("id", F.lit("third")), F.lit(3)) == 0), "labelled")

    @F.arrow_udf("array<binary>")
    def some(texts: pa.Array) -> pa.Array:
        return pa.array([spread(_pieces(t.as_py()), pieces) for t in texts], pa.list_(pa.binary()))

    taught = sorted(found.filter(~F.col("third")).select("id", "label", some("text").alias("some")).collect(), key=lambda r: (str(r["id"]), r["label"]))
    held = {v: [bytes(p) for r in taught if r["label"] == v for p in r["some"]] for v in (1, 0)}
    if not all(held.values()):
        return None, share
    good, bad = (_dictionary(held[v], size) for v in (1, 0))

    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([_features(t.as_py(), good, bad) for t in texts], pa.list_(pa.float64()))

    seen = sorted(((tuple(r["of"]), r["label"]) for r in found.filter("third").select("label", of("text").alias("of")).collect()))
    if len({v for _, v in seen}) < 2:
        return None, share
    known = np.array([v for _, v in seen])
    return QualityModel(good, bad, Logistic(np.array([f for f, _ in seen]), known, prior_weights(known, share))), share


def score(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
    folds: int = 5, held: int = 0, threshold: float = 0.3, **limits,
) -> DataFrame:
    """docs with held_out, score (0 to 1, higher: label 1 likelier) and predicted.

    Rows whose crc32(id as text) mod `folds` is `held` are held out: their labels are not
    learned. A null id is not held out and teaches nothing. A null text counts as empty; every
    text is compressed whole. Repeated rows get the same score. If there are no labels of both
    kinds, every row gets label 1's share (one half without any label). A column of docs that
    is called like a new one is replaced; other columns stay. An empty table gives no rows.
    """
    with settings(docs.sparkSession):
        model, share = train(docs, labels, id, text, label, fold(id, folds) != held, **limits)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.full(len(texts), share) if model is None else model.scores(texts.to_pylist()))

    scored = docs.withColumn("held_out", F.coalesce(fold(id, folds) == held, F.lit(False)))
    scored = scored.withColumn("score", of(F.col(f"`{text}`")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
