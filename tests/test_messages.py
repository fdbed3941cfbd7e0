"""Decoding, encoding and flagging of messages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterline.functions import word_tokens
from rosterline.operators import messages
from rosterline.schemas import MESSAGE

TEXTS = ["hello bad world", "BAD", "bad zzz", "hello world", "", None, "bad, bad; hello!", "größe bad"]
KEPT = {"hello bad world", "BAD", "bad, bad; hello!"}


@pytest.fixture
def words(spark):
    def make(*items):
        return spark.createDataFrame([(w,) for w in items], "word string")

    return make


@pytest.mark.parametrize("inline_marked", [0, 10])
@pytest.mark.parametrize("inline_vocab", [0, 10])
def test_flagging(spark, words, inline_marked, inline_vocab):
    data = spark.createDataFrame([("s", "r", t) for t in TEXTS + ["BAD"]], MESSAGE)
    kept = messages.keep_flagged(
        data, words("BAD"), words("HELLO", "BAD", "WORLD", "WORLD", None),
        inline_marked=inline_marked, inline_vocab=inline_vocab,
    )
    got = [r.message for r in kept.collect()]
    assert set(got) == KEPT and got.count("BAD") == 2 and len(got) == 4


def test_no_marked_words(spark, words):
    data = spark.createDataFrame([("s", "r", "hello")], MESSAGE)
    assert messages.keep_flagged(data, words(), words("HELLO")).isEmpty()


def test_flag_stamps_the_sender(spark, words, rows):
    data = spark.createDataFrame([("s1", "r", "bad"), ("s2", "r", "good")], MESSAGE)
    now = dt.datetime(2024, 3, 1, 12)
    assert rows(messages.flag(data, words("BAD"), words("BAD", "GOOD"), now)) == [("s1", now)]


def test_decode(spark, rows):
    data = spark.createDataFrame(
        [('{"sender":"a","receiver":"b","message":"hi"}',), ("not json",), ('{"sender":"a"}',), (None,)],
        "value string",
    )
    assert rows(messages.decode(data)) == [
        ("a", "b", "hi"), ("a", None, None), (None, None, None), (None, None, None),
    ]
    as_bytes = data.select(F.col("value").cast("binary").alias("value"))
    assert rows(messages.decode(as_bytes)) == rows(messages.decode(data))


def test_encode_drops_incomplete_and_round_trips(spark, rows):
    data = spark.createDataFrame(
        [("a", "b", 'q"\n é'), ("a", None, "x"), (None, "b", "x"), ("a", "b", None)], MESSAGE
    )
    sent = messages.encode(data)
    assert [r.key for r in sent.collect()] == ["a"]
    assert rows(messages.decode(sent)) == [("a", "b", 'q"\n é')]


def test_tokens_keep_accents_digits_and_underscores(spark):
    df = spark.createDataFrame([("Été_1, größer-kleiner!",)], "t string")
    assert df.select(word_tokens("t", "lower")).first()[0] == ["été_1", "größer", "kleiner"]
    assert df.select(word_tokens("t")).first()[0] == ["ÉTÉ_1", "GRÖSSER", "KLEINER"]


def test_long_text_is_tested_whole(spark, words):
    """One unknown word at the very end of a long text decides."""
    long = " ".join(["hello"] * 20_000)
    data = spark.createDataFrame([("s", "r", long + " bad"), ("s", "r", long + " bad unknown")], MESSAGE)
    for inline in (0, 10):
        kept = messages.keep_flagged(data, words("BAD"), words("HELLO", "BAD"), inline_vocab=inline)
        assert kept.count() == 1


def test_digest_is_taken_before_the_words_are_spread(spark, words):
    data = spark.createDataFrame([("s", "r", "bad")], MESSAGE)
    kept = messages.keep_flagged(data, words("BAD"), words("BAD"), inline_vocab=0)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    generate = plan[plan.index("Generate explode"):]
    assert "sha2" in generate and not any("sha2" in line for line in plan.splitlines() if "Generate explode" in line)
