"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import fold, sample
from .staging import picked, settings

# N-grams of these lengths are features, known by a 64-bit hash. A table over the first BUCKET_BITS
# bits sorts out most n-grams that are none before the whole hash is looked up.
LENGTHS = (4, 6, 8)
BUCKET_BITS = 20
# An n-gram that a text repeats is a further feature where it begins at least so many times a word.
# The last two bits of a hash name the feature: 0 the n-gram, 1 and 2 these frequencies.
FREQUENCIES = (1 / 128, 1 / 64)
NAMES = np.uint64(3)
# Characters looked at together; blocks overlap so that no n-gram is lost between them.
BLOCK = 1 << 20
# Fitting counts in a table of 2 ** COUNT_BITS first and then takes the hashes in so many slices.
COUNT_BITS, SLICES = 24, 16
# Fixed value: the odd multiplier of the n-gram hash.
MULTIPLIER = 0x9E3779B97F4A7C15


def _normal(text: str | None) -> np.ndarray:
    """Lower-cased code points with one space around and between words."""
    words = " ".join((text or "").lower().split())
    return np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), "<u4")


def hashes(points: np.ndarray) -> Iterator[np.ndarray]:
    """The hashes of all n-grams of a whole text, block by block, each place once; the last two bits are 0."""
    for low in range(0, max(1, len(points)), BLOCK):
        mixed = points[low : low + BLOCK + LENGTHS[-1] - 1].astype(np.uint64) * np.uint64(MULTIPLIER)
        rolled = mixed.copy()
        for n in range(2, LENGTHS[-1] + 1):
            if len(mixed) < n:
                break
            rolled = (rolled[:-1] ^ (rolled[:-1] >> np.uint64(29))) * np.uint64(MULTIPLIER) + mixed[n - 1 :]
            if n in LENGTHS:
                yield rolled[:BLOCK] & ~NAMES


def _named(found: list[np.ndarray], points: np.ndarray) -> np.ndarray:
    """The distinct features, in order, of the n-grams found in a text."""
    known, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
    words = max(1, int((points == 32).sum()) - 1)
    repeated = [known[(counts > 1) & (counts >= f * words)] | np.uint64(i) for i, f in enumerate(FREQUENCIES, 1)]
    return np.sort(np.concatenate([known, *repeated]))


def buckets(text: str | None) -> np.ndarray:
    """The distinct features of a whole text, in order."""
    points = _normal(text)
    return _named(list(hashes(points)), points)


@dataclass(frozen=True)
class ToxicityModel:
    """features: the hashes of the chosen n-grams in order; weights: of each, the log-count ratio times the coefficient."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def _margin(self, text: str | None, likely: np.ndarray) -> float:
        points = _normal(text)
        found = _named([part[likely[part >> np.uint64(64 - BUCKET_BITS)]] for part in hashes(points)], points)
        at = np.minimum(np.searchsorted(self.features, found), max(0, len(self.features) - 1))
        hit = at[self.features[at] == found] if len(self.features) else at[:0]
        return float(self.weights[hit].sum(dtype=np.float64))

    def scores(self, texts) -> np.ndarray:
        likely = np.zeros(1 << BUCKET_BITS, bool)
        likely[self.features >> np.uint64(64 - BUCKET_BITS)] = True
        margins = np.array([self._margin(t, likely) for t in texts], float)
        return 1 / (1 + np.exp(-np.clip(margins + self.intercept, -30, 30)))


def blocks_of(text: str, chars: int) -> list[str]:
    """A text in blocks of at most `chars` characters; they overlap so that no n-gram is lost."""
    step = max(1, chars - LENGTHS[-1] + 1)
    return [text[low : low + chars] for low in range(0, max(1, len(text) - LENGTHS[-1] + 1), step)]


def _frequent(cut: list[list[str]], least: int) -> list[np.ndarray]:
    """The features of each block of each text without those that, by a table of counts, cannot be in `least` texts."""
    shift = np.uint64(64 - COUNT_BITS)
    counts = np.zeros(1 << COUNT_BITS, np.int32)
    for blocks in cut:
        counts[np.unique(np.concatenate([buckets(b) for b in blocks]) >> shift)] += 1
    enough = counts >= least
    return [f[enough[f >> shift]] for blocks in cut for f in map(buckets, blocks)]


def _first(rows: np.ndarray, cols: np.ndarray, text_of: np.ndarray, several: np.ndarray) -> np.ndarray:
    """Whether an entry (block, feature) is the first of its text; only texts of several blocks need a look."""
    out = np.ones(len(rows), bool)
    look = np.flatnonzero(several[text_of[rows]])
    if len(look):
        _, at = np.unique(cols[look].astype(np.int64) * len(several) + text_of[rows[look]], return_index=True)
        out[look] = False
        out[look[at]] = True
    return out


def fit(
    texts: list[str], labels: list[int], share: float, least: int = 4, strength: float = 4.0,
    penalty: float = 0.02, rounds: int = 300, chars: int = 6000,
) -> ToxicityModel | None:
    """A model from labelled texts, None if one of the labels is missing.

    A feature is an n-gram that occurs, or one that is repeated at a frequency of FREQUENCIES:
    by chance a long text has most n-grams, but none too often. The log-count ratio of a feature
    compares in how many texts of either label it occurs (add-one smoothed). Features in fewer than `least` texts, or whose ratio is within
    `strength` standard errors of zero, are left out (a text counts once, in however many blocks): otherwise thousands of chance features
    would decide about long texts. The coefficients are fitted by accelerated gradient steps
    on the L2-penalised log-loss, with label 1 weighted to its `share`. A text of more than
    `chars` characters is fitted on in blocks that share its weight.
    """
    if len(set(labels)) < 2:
        return None
    cut = [blocks_of(t, chars) for t in texts]
    y = np.repeat(np.array(labels, float), [len(c) for c in cut])
    each = np.repeat([1 / len(c) for c in cut], [len(c) for c in cut])
    text_of = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
    several = np.array([len(c) > 1 for c in cut])
    ones = sum(labels)
    zeros = len(labels) - ones
    found = _frequent(cut, least)
    features, ratios, at, of, n = [], [], [], [], 0
    for low in range(SLICES):  # a share of the hashes at a time, so that little is held at once
        edge = [np.uint64(low * (1 << 64) // SLICES), np.uint64((low + 1) * (1 << 64) // SLICES - 1)]
        parts = [f[np.searchsorted(f, edge[0]) : np.searchsorted(f, edge[1], "right")] for f in found]
        rows = np.repeat(np.arange(len(parts), dtype=np.int32), [len(f) for f in parts])
        known, cols = np.unique(np.concatenate(parts), return_inverse=True)
        hot, first = y[rows] == 1, _first(rows, cols, text_of, several)
        p = np.bincount(cols[hot & first], minlength=len(known))
        q = np.bincount(cols[~hot & first], minlength=len(known))
        ratio = np.log((p + 1) / (ones + 2)) - np.log((q + 1) / (zeros + 2))
        error = np.sqrt(1 / (p + 1) + 1 / (q + 1))
        use = (p + q >= least) & (np.abs(ratio) >= strength * error)
        inside = use[cols]
        at.append(rows[inside])
        of.append((n + np.cumsum(use) - 1)[cols[inside]].astype(np.int32))
        features.append(known[use])
        ratios.append(ratio[use])
        n += int(use.sum())
    del found
    chosen, r, rows, cols = [np.concatenate(x) for x in (features, ratios, at, of)]
    if not len(chosen):
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0, np.float32), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    values = r[cols]
    weight = each * np.where(y == 1, share / (each * y).sum(), (1 - share) / (each * (1 - y)).sum())
    square = np.bincount(rows, values**2, minlength=len(y)).max() + 1
    step = 4 / (square + 4 * penalty)
    w, look, b, momentum = np.zeros(len(chosen)), np.zeros(len(chosen)), 0.0, 1.0
    look_b = b
    for _ in range(rounds):
        margin = np.bincount(rows, values * look[cols], minlength=len(y)) + look_b
        miss = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        new_w = look - step * (np.bincount(cols, values * miss[rows], minlength=len(chosen)) + penalty * look / len(y))
        new_b = look_b - min(1.0, 20 * step) * miss.sum()
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        look, look_b = new_w + (momentum - 1) / after * (new_w - w), new_b + (momentum - 1) / after * (new_b - b)
        w, b, momentum = new_w, new_b, after
    return ToxicityModel(chosen, (w * r).astype(np.float32), float(b))


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    kept: Column | None = None, rows: int = 2000, chars: int = 6000, **options,
) -> tuple[ToxicityModel | None, float]:
    """The model and label 1's share among the labels that may be learned.

    Fitted on at most `rows` labelled documents per label (a documented bound, see
    `labelled.sample`; the share is counted over all labels), whole, in blocks of `chars` characters.
    """
    kept = F.lit(True) if kept is None else kept
    found, share = sample(docs, labels, id, text, label, kept, rows)
    return fit([t for t, _ in found], [v for _, v in found], share, chars=chars, **options), share


def score(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    folds: int = 4, held: int = 2, threshold: float = 0.3, **limits,
) -> DataFrame:
    """docs with held_out, score (0 to 1, higher: label 1 likelier) and predicted.

    Rows whose crc32(id as text) mod `folds` is `held` are held out: their labels are not
    learned. A null id is not held out and teaches nothing. A null text counts as empty; every
    text is read whole, in overlapping blocks. Repeated rows get the same score. If there are
    no labels of both kinds, every row gets label 1's share (one half without any label). A
    column of docs that is called like a new one is replaced; other columns stay. An empty
    table gives no rows. The model, the chosen n-grams, is sent once per executor.
    """
    spark = docs.sparkSession
    with settings(spark):
        model, share = train(docs, labels, id, text, label, fold(id, folds) != held, **limits)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.full(len(texts), share) if sent.value is None else sent.value.scores(texts))

    scored = docs.withColumn("held_out", F.coalesce(fold(id, folds) == held, F.lit(False)))
    scored = scored.withColumn("score", of(F.col(f"`{text}`")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
