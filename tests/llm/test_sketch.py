import hashlib

from pyspark.sql import functions as F

from rosterline.llm import sketch as k


def edits(rows):
    """{(id, text): edited text} by going through the distinct rows in order; ids are unique or null here."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for i, (id, text) in enumerate(rows):
        n, after = len(text), rows[(i + 1) % len(rows)][1]
        out[id, text] = text[: n - n // 2] + after[: n // 2]
    return out


def test_edited_texts_and_likeness(documents):
    want = edits([(r.doc_id, r.text) for r in documents.collect()])
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = k.with_edits(documents).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id]
        edited = want[r.doc_id, text]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) <= (r.near_edited == 1)
    shingles = lambda t: {tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} if t.split() else set()
    apart = [abs(r.near_edited - len(shingles(texts[r.doc_id]) & shingles(want[r.doc_id, texts[r.doc_id]])) / len(shingles(texts[r.doc_id]))) for r in rows if r.n_chars > 1000]
    assert sum(apart) / len(apart) < 0.08
    assert sum(r.near_edited > r.near_next for r in rows) >= 0.9 * len(rows)


def test_sketches_keep_what_lies_below_the_fraction(spark, documents):
    both = k.with_sketch(k.with_sketch(documents, "text", "all", 1.0), "text", "part", 0.25)
    for r in both.collect():
        assert r.all == sorted(set(r.all))
        low = [h for h in r.all if h < 2**61]
        assert r.part == (low or r.all[:1])
    pair = spark.createDataFrame([("a b c d e f g h i j", "f g h i j k l m n")], "x string, y string").withColumn("xy", F.lit("a b c d e f g h i j k l m n"))
    for name in ("x", "y", "xy"):
        pair = k.with_sketch(pair, name, f"s{name}", 1.0)
    r = pair.select(k.merged(F.col("sx"), F.col("sy"), 1.0).alias("m"), "sxy", k.containment(F.col("sx"), F.col("sxy")).alias("c")).first()
    assert r.c == 1.0 and set(r.m) == set(r.sxy)


def test_awkward_rows(awkward):
    rows = k.with_edits(awkward).collect()
    assert len(rows) == awkward.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert all(r.n_chars == 0 and r.fingerprint == "" for i in (1, 2, 3) for r in by[i])
    assert len(by[4]) == 2 and by[4][0] == by[4][1] and by[4][0].fingerprint == by[5][0].fingerprint
    assert by[7][0].fingerprint == "" and by[8][0].n_chars == 8
    text = "é ñ 漢字 \U0001F600"
    first = [r for r in rows if r.doc_id is None]
    assert len(first) == 2
    heads = {hashlib.sha256((text[:4] + after[:4]).encode()).hexdigest() for after in ("", "no id at all")}
    assert by[8][0].edited_sha256 in heads
    assert k.with_edits(awkward.limit(0)).count() == 0
    alone = k.with_edits(awkward.filter("doc_id = 8")).first()
    assert alone.edited_sha256 == hashlib.sha256((text[:4] + text[:4]).encode()).hexdigest() and alone.near_next == 1


def test_order_over_many_ranges(spark):
    frame = spark.range(0, 5000, 3).selectExpr("id as doc_id", "concat('t', id) as text").repartition(7)
    found = k.successors(frame, ["doc_id", "text"]).collect()
    ids = sorted(r.doc_id for r in found)
    assert {r.doc_id: r.next_doc_id for r in found} == {a: b for a, b in zip(ids, ids[1:] + ids[:1], strict=True)}
