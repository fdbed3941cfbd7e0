import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rosterline.llm import target_resampling as tr

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def runs(text, n, buckets):
    found = words(text)
    return [zlib.crc32(" ".join(found[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(found) - k + 1)]


def brute(docs, target, n=1, buckets=10_000, percent=10, least=20, seed=2024):
    s = Counter(b for _, t in docs for b in runs(t, n, buckets))
    t = Counter(b for x in target for b in runs(x, n, buckets))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(float(t[b] + 1) * (all_s + buckets) / (float(s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text in docs:
        found = runs(text, n, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, found)) // len(found) if found else 0
        out.append((i, len(words(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    long = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = Counter((r[0], r[2], r[3], r[4], k) for k, r in enumerate(long[: percent * len(long) // 100], 1))
    rest = Counter((r[0], r[2], r[3], r[4], None) for r in long[percent * len(long) // 100 :] + [r for r in out if r[1] < least])
    return drawn + rest


def found(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"n": 3, "buckets": 100_000, "percent": 50, "least": 1}, {"entries": 0}, {"percent": 0}, {"percent": 100, "least": 0}])
def test_against_brute_force(spark, documents, options):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [r.text for r in target.collect()], **{k: v for k, v in options.items() if k != "entries"})
    assert found(tr.resample(documents, target, **options)) == want


def test_awkward_rows(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    target = spark.createDataFrame([("Lorem ipsum",), (None,), ("",)], "text string")
    for options in ({"least": 0, "percent": 60}, {"n": 2, "least": 1, "percent": 100}):
        assert found(tr.resample(awkward, target, **options)) == brute(rows, ["Lorem ipsum", None, ""], **options)
    assert found(tr.resample(awkward, target.limit(0), least=1)) == brute(rows, [], least=1)
    assert tr.resample(awkward.limit(0), target).collect() == []


def test_ties_and_repeated_rows(spark):
    docs = spark.createDataFrame([(5, "same text here")] * 40 + [(i % 7, "same text here") for i in range(60)], "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = spark.createDataFrame([("other",)], "text string")
    assert found(tr.resample(docs, target, least=3, percent=33)) == brute(rows, ["other"], least=3, percent=33)


def test_payloads_compose():
    parts = [b"", b"a", b"word", "é漢".encode(), b"x" * 1000]
    for a in parts:
        for b in parts:
            assert int(tr.composed(np.array([zlib.crc32(a)]), np.array([zlib.crc32(b)]), np.array([len(b)]))[0]) == zlib.crc32(a + b)


@pytest.mark.parametrize("entries", [[], [b"the", b"he", b"thecat", "é".encode()], [b"cat", b"a"]])
def test_the_dictionary_changes_nothing(entries, monkeypatch):
    text = "The cat, thecat! he-the é é漢字 9x THE\x00the a a a" * 50
    want = (len(words(text)), runs(text, 3, 977))
    known = tr.Dictionary(entries)
    for block in (1 << 20, 7):
        monkeypatch.setattr(tr, "BLOCK", block)
        count, features = known.features(text, 3, 977)
        assert (count, Counter(features.tolist())) == (want[0], Counter(want[1]))
    assert known.features("A" * 300_000, 2, 977)[0] == 1 and known.features("", 2, 977)[0] == 0
