import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rosterline.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(open(PATH, encoding="utf-8").read())


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_ids_are_those_of_the_tokenizers_library(encoder, tokenizer, text):
    assert list(encoder.ids(text)) == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_special_strings_and_long_runs(encoder, tokenizer):
    for text in ("<|endoftext|> a", "a" * 5000, " \n" * 3000, "\u0085　x", "I'll 'S '"):
        assert list(encoder.ids(text)) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_special_strings_have_the_ids_of_an_unmodified_tokenizer(name):
    path = public_tokenizers.path(name)
    plain, encoder = Tokenizer.from_file(path), packing.token_encoder(open(path, encoding="utf-8").read())
    for text in ("a <|endoftext|> b", "<|endoftext|><|endoftext|>x", " <|endoftext|>  y\n", "x  \n<|endoftext|>", "<|endoftext>", "<|endoftext|>'s"):
        assert list(encoder.ids(text)) == plain.encode(text, add_special_tokens=False).ids


def test_documents_with_special_strings(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "many words <|endoftext|> " * 900, "none"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(frame, packing.pack(frame, PATH).collect(), Tokenizer.from_file(PATH))


def test_a_tokenizer_of_another_kind_is_used_as_it_is():
    source = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    encoder = packing.Encoder(source)
    assert encoder.plain is None
    assert list(encoder.ids("Hello world")) == Tokenizer.from_str(source).encode("Hello world", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_plan_places_every_token_once(lengths):
    counts = np.bincount(lengths, minlength=65)
    rules, n = packing.plan(counts, 64)
    windows, used = defaultdict(list), defaultdict(list)
    for kind, low, high, spent, length, sequence, each, position, offset in rules:
        for rank in range(low, high):
            at = position + rank - low
            windows[sequence + at // each].append((offset + at % each * length, length))
            used[kind, rank].append((spent, length))
    assert set(windows) == set(range(n)) and len(used) == len(lengths)
    short = [_gapless(w) for w in windows.values()]
    assert all(s == 64 or s & (s - 1) == 0 for s in short) and sum(s < 64 for s in short) <= 6
    assert all(_gapless(u) == kind for (kind, _), u in used.items())


def _gapless(spans):
    end = 0
    for start, length in sorted(spans):
        assert start == end
        end += length
    return end


def test_best_fill_has_the_least_slack():
    rng = np.random.default_rng(2)
    for _ in range(200):
        counts = np.zeros(31, int)
        for n in rng.integers(1, 31, 6):
            counts[n] += 1
        items = [n for n, c in enumerate(counts) for _ in range(c)]
        sums = {0}
        for n in items:
            sums |= {s + n for s in sums}
        got = packing.best_fill(counts, 30)
        assert sum(n * k for n, k in got.items()) == max(s for s in sums if s <= 30)
        assert all(k <= counts[n] for n, k in got.items())


def check(frame, out, tokenizer):
    docs = defaultdict(list)
    for r in frame.collect():
        docs[r.doc_id].append(np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], np.uint32))
    windows, tokens = defaultdict(list), defaultdict(int)
    for r in out:
        windows[r.sequence_id].append((r.offset, r.length))
        tokens[r.doc_id] += r.length
        sums = [zlib.crc32(d[r.start : r.start + r.length].astype("<u4").tobytes()) for d in docs[r.doc_id] if len(d) == r.doc_tokens]
        assert r.ids_crc32 in sums
    assert dict(tokens) == {i: sum(map(len, d)) for i, d in docs.items()}
    short = [n for n in map(_gapless, windows.values()) if n < 1024]
    assert all(n & (n - 1) == 0 for n in short) and len(short) <= 10
    return windows


def test_documents(documents, tokenizer):
    check(documents, packing.pack(documents, PATH).collect(), tokenizer)


def test_awkward_rows(awkward, tokenizer):
    check(awkward, packing.pack(awkward, PATH).collect(), tokenizer)
    assert packing.pack(awkward.limit(0), PATH).count() == 0


def test_one_length_only(spark, tokenizer):
    frame = spark.createDataFrame([(i, "same words in every text " * 60) for i in range(40)], "doc_id long, text string")
    check(frame, packing.pack(frame, PATH).collect(), tokenizer)


@pytest.mark.parametrize("blank", [" ", "\t", "\u00a0", " \n"])
def test_very_long_white_space_inside_a_document(spark, blank):
    """The fast encoder refuses such texts; they get the ids of the library all the same."""
    run = blank * (2_000_000 // len(blank))
    texts = [f"before {run}after", run, "plain"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(frame, packing.pack(frame, PATH).collect(), Tokenizer.from_file(PATH))


def test_texts_are_encoded_once_and_cut_pieces_join_without_them(spark, monkeypatch):
    texts = [f"word{i} " * (250 + i % 7) for i in range(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = packing.pack(frame, PATH)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan and "text" not in plan
    assert max(len([r for r in done.collect() if r.doc_id == i]) for i in range(200)) > 1
    check(frame, done.collect(), Tokenizer.from_file(PATH))
