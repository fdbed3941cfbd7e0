import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterline.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache(), spark.read.parquet(f"{SF}/labels.parquet").cache()


def ranked(rows, label):
    """Chance that a row of label 1 scores above one of label 0."""
    ones, zeros = [r.score for r in rows if r[label] == 1], [r.score for r in rows if r[label] == 0]
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.mark.parametrize("module, label, folds, held", [(quality, "quality", 5, 0), (toxicity, "toxic", 4, 2)])
def test_held_out_documents(tables, module, label, folds, held):
    docs, labels = tables
    rows = module.score(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    out = [r for r in rows if r.held_out]
    assert ranked(out, label) > 0.8
    assert sum(r.predicted == r[label] for r in out) / len(out) > 0.85
    if label == "quality":
        assert sum(r.predicted for r in out if r.quality == 1) >= 0.97 * sum(r.quality == 1 for r in out)


def test_toxic_documents_of_every_language_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, labels).join(labels, "doc_id").filter("held_out").select("lang", "toxic", "predicted").collect()
    for lang in {r.lang for r in rows}:
        found = [r.predicted for r in rows if r.lang == lang and r.toxic == 1]
        assert len(found) < 10 or sum(found) >= 0.85 * len(found), lang
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(clean) <= 0.01 * len(clean)


def test_words_that_plain_texts_have_by_chance_count_where_they_are_repeated():
    rng = __import__("random").Random(7)
    plain = lambda n: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n)]
    some = lambda n, times: " ".join(rng.sample(plain(n) + ["grobian"] * times, n + times))
    texts = [some(300, 1) for _ in range(300)] + [some(300, 9) for _ in range(60)]
    model = toxicity.fit(texts, [0] * 300 + [1] * 60, 1 / 6)
    assert max(model.scores([some(300, 1), some(20_000, 60)])) < 0.3
    assert min(model.scores([some(300, 9), some(20_000, 600)])) >= 0.3


def test_a_long_text_that_repeats_an_ngram_is_one_text():
    texts = [f"plain words number {i}" for i in range(100)] + ["odd phrase " * 5000] + [f"you idiot number {i}" for i in range(50)]
    model = toxicity.fit(texts, [0] * 100 + [1] * 51, 0.3, chars=100, strength=0)
    assert not set(toxicity.buckets("odd phrase").tolist()) & set(model.features.tolist()) - set(toxicity.buckets(" ".join(texts[:100] + texts[101:])).tolist())


@pytest.mark.parametrize("module, label, held", [(quality, "quality", 0), (toxicity, "toxic", 2)])
def test_held_out_labels_are_not_learned(tables, module, label, held):
    docs, labels = tables
    folds = 5 if label == "quality" else 4
    out = F.crc32(F.col("doc_id").cast("string")) % folds == held
    turned = labels.withColumn(label, F.when(out, 1 - F.col(label)).otherwise(F.col(label)))
    scores = lambda known: {r.doc_id: r.score for r in module.score(docs, known).collect()}
    assert scores(labels) == scores(turned)


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_awkward_rows(spark, awkward, tables, module, label):
    docs, labels = tables
    texts = docs.select("doc_id", "text").union(awkward.selectExpr("doc_id + 100000", "text"))
    rows = [r for r in module.score(texts, labels).collect() if r.doc_id is None or r.doc_id > 99999]
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (100001, 100002, 100003)}) == 1
    assert all(not r.held_out for r in rows if r.doc_id is None)
    got = module.score(awkward, labels.limit(0))
    assert {r.score for r in got.collect()} == {0.5} and "lang" in got.columns and got.columns.count("score") == 1
    assert module.score(awkward.limit(0), labels).count() == 0
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 7), (4, 1), (4, 0)], f"doc_id long, {label} int")
    assert module.score(awkward, odd).count() == awkward.count()


def test_a_toxic_word_anywhere_in_a_long_text_counts():
    texts = [f"plain words number {i} here" for i in range(300)] + [f"plain words number {i} you idiot" for i in range(100)]
    model = toxicity.fit(texts, [0] * 300 + [1] * 100, 0.25)
    long = "plain words here " * 200_000
    clean, toxic = model.scores([long, long + "you idiot " + long])
    assert clean < 0.3 < toxic


def test_features_cross_block_borders(monkeypatch):
    text = "".join(chr(97 + i * i % 26) for i in range(500))
    whole = set(toxicity.buckets(text).tolist())
    monkeypatch.setattr(toxicity, "BLOCK", 50)
    assert set(toxicity.buckets(text).tolist()) == whole


def test_chance_hits_do_not_decide_about_a_long_text_of_many_words():
    rng = __import__("random").Random(5)
    plain = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n))
    model = toxicity.fit([plain(8) for _ in range(300)] + [plain(8) + " you idiot" for _ in range(100)], [0] * 300 + [1] * 100, 0.25)
    long = plain(200_000)
    found, short = [toxicity.buckets(t) for t in (long, "you idiot")]
    hits = set(model.features.tolist()) & set(found.tolist())
    assert len(hits) <= len(model.features) and len(found) > 1_000_000 and len(short)
    alone = model.scores([""])[0]
    exact = model.weights[np.isin(model.features, found)].sum(dtype=float) + model.intercept
    assert model.scores([long])[0] == pytest.approx(1 / (1 + np.exp(-exact))) and alone < 0.3


def test_long_labelled_texts_are_learned(spark):
    rows = [(i, "plain words here " * 500 + ("you idiot " if i % 2 else "")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    out = toxicity.score(docs, labels).collect()
    assert {r.predicted for r in out if r.doc_id % 2} == {1}
    assert all(t in "".join(toxicity.blocks_of("abcdefgh" * 9, 20)) for t in ("abcdefgh",))


def test_long_labelled_texts_teach_quality(spark):
    """A text of 100,000 characters, whose end alone tells, is fitted on like any other."""
    rng = __import__("random").Random(3)
    noise = lambda n: " ".join("".join(rng.choices("bcdfghjklm", k=6)) for _ in range(n))
    rows = [(i, noise(9_000) + " " + ("well written sentences about rivers and mountains " if i % 2 else "click here buy now cheap pills ") * 900) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    assert min(len(t) for _, t in rows) > 80_000
    model, share = quality.train(docs, labels)
    good, bad = model.scores(["well written sentences about rivers and mountains " * 20, "click here buy now cheap pills " * 20])
    assert share == 0.5 and good > 0.9 and bad < 0.5
    few, _ = quality.train(docs.withColumn("text", F.substring("text", 1, 20_000)), labels)
    assert few is None or abs(few.scores(["well written sentences about rivers and mountains " * 20])[0] - good) > 1e-6


def test_pieces_come_from_all_over_a_text():
    pieces = [bytes([i]) for i in range(100)]
    assert quality.spread(pieces, 100) == pieces
    some = quality.spread(pieces, 7)
    assert len(some) == 7 and some[0] == b"\x00" and some[-1] >= bytes([80])
