"""Bounded samples of labelled documents, and the calibration both classifiers share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .staging import picked, small_table


def fold(id: str, folds: int) -> Column:
    """The remainder of the CRC-32 of the id as text; null for a null id."""
    return F.crc32(F.col(f"`{id}`").cast("string")) % folds


def chosen(
    docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, kept: Column, rows: int
) -> tuple[DataFrame | None, float]:
    """(id, label, text) of at most `rows` documents per label, and label 1's share among all labels.

    `kept` restricts the ids whose labels may be learned. Labels other than 0 and 1 and null
    ids or labels are ignored; an id labelled twice counts with its smallest label. Ids are
    chosen by the smallest hash, so the same tables give the same sample; from the labels
    alone, so that the texts are read once and not shuffled: the chosen ids, at most 2 * rows,
    are broadcast. Texts are whole. Without any label there is no frame and the share is one half.
    """
    known = (
        picked(labels, id, label)
        .filter(kept & F.col(f"`{label}`").isin(0, 1))
        .groupBy(F.col(f"`{id}`").alias("id"))
        .agg(F.min(f"`{label}`").cast("int").alias("label"))
        .filter("id IS NOT NULL")
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    place = F.shiftrightunsigned(F.xxhash64("id"), 33)  # 31 bits
    ids = []
    for value, count in counts.items():
        # a little more than the share that is wanted, so that no task gives many
        low = int(min(1.0, 1.3 * rows / count + 100 / count) * (2**31 - 1))
        part = known.filter((F.col("label") == value) & (place <= low))
        ids += [(r["id"], value) for r in part.orderBy(place, "id").limit(rows).select("id").collect()]
    if not ids:
        return None, 0.5
    kind = to_arrow_type(known.schema["id"].dataType)
    table = small_table(docs.sparkSession, id=pa.array([i for i, _ in ids], kind), label=pa.array([v for _, v in ids], pa.int32()))
    texts = picked(docs, *dict.fromkeys([id, text])).select(
        F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    found = texts.join(F.broadcast(table), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    return found, counts.get(1, 0) / total


def sample(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, kept: Column, rows: int) -> tuple[list[tuple[str, int]], float]:
    """The (text, label) pairs of `chosen` on the driver, in the order of their ids, and the share."""
    table, share = chosen(docs, labels, id, text, label, kept, rows)
    found = sorted(table.collect(), key=lambda r: (str(r["id"]), r["label"])) if table else []
    return [(r["text"], r["label"]) for r in found], share


class Logistic:
    """Logistic regression on a few standardised features, fitted by Newton steps."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, weights: np.ndarray, penalty: float = 1.0):
        self.mean, self.scale = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-9)
        x = self._design(features)
        self.w = np.zeros(x.shape[1])
        ridge = np.diag([0.0] + [penalty] * features.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ self.w, -30, 30)))
            gradient = x.T @ (weights * (labels - p)) - ridge @ self.w
            curve = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(self.w))
            step = np.linalg.solve(curve, gradient)
            self.w += step
            if np.abs(step).max() < 1e-8:
                break

    def _design(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(z), 1)), z], axis=1)

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._design(features) @ self.w, -30, 30)))


def prior_weights(labels: np.ndarray, share: float) -> np.ndarray:
    """Weights under which label 1 has the given share of the sample."""
    ones = labels.mean()
    return np.where(labels == 1, share / max(ones, 1e-9), (1 - share) / max(1 - ones, 1e-9))
