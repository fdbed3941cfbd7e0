"""Message decoding and word-list flagging."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import moment, word_tokens
from ..schemas import MESSAGE

def decode(df: DataFrame, schema: StructType = MESSAGE, value: str = "value") -> DataFrame:
    """JSON text or bytes to columns; malformed text gives a row of nulls."""
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return df.select(parsed.alias("data")).select("data.*")


def encode(df: DataFrame, schema: StructType = MESSAGE, key: str = "sender") -> DataFrame:
    """Complete messages as key and JSON value; incomplete ones are dropped."""
    names = schema.fieldNames()
    full = df.dropna(subset=names)
    return full.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*names)).alias("value")
    )


Words = DataFrame | list[str]


def word_values(words: Words) -> list[str]:
    """The words as a list; a frame is fetched, which is for short lists."""
    if isinstance(words, list):
        return words
    column = words.columns[0]
    return [r[0] for r in words.select(column).dropna().distinct().collect()]


def _frame(spark, words: Words) -> DataFrame:
    if isinstance(words, list):
        return spark.range(1).select(F.explode(F.lit(words).cast("array<string>")).alias("listed"))
    return words.select(F.col(words.columns[0]).alias("listed"))


def _has_any(tokens: Column, words: list[str]) -> Column:
    return F.exists(tokens, lambda w: w.isin(words)) if words else F.lit(False)


def _has_only(tokens: Column, words: list[str]) -> Column:
    return F.forall(tokens, lambda w: w.isin(words)) if words else F.size(tokens) == 0


def _words(rows: DataFrame, tokens: Column) -> DataFrame:
    """(text_digest, word): each word of each row once."""
    words = rows.select("text_digest", F.array_distinct(tokens).alias("words"))
    return words.select("text_digest", F.explode("words").alias("word"))


def keep_flagged(
    df: DataFrame,
    marked: Words,
    vocab: Words,
    text: str = "message",
    fold: str = "upper",
    inline_marked: bool = True,
    inline_vocab: bool = False,
) -> DataFrame:
    """Rows whose text has a marked word and consists of vocabulary words only.

    The caller says how each list is used, whatever its length. Inline, it becomes literals
    of the plan, fetched when this is called, and is tested inside the row; that suits a
    short list that does not change. Otherwise it is joined, and read whenever the plan
    runs: each word travels with a digest of its text, never the text itself. Marked words
    come first, so that only the words of texts with one (few, as a rule) meet the vocabulary;
    those that are not in it give the texts to leave out. All joins are anti or semi joins, so
    Spark may split a frequent word and a text that is repeated often.
    """
    spark, tokens = df.sparkSession, word_tokens(text, fold)
    candidates = df.filter(F.col(text).isNotNull())
    if inline_marked:
        candidates = candidates.filter(_has_any(tokens, word_values(marked)))
    if inline_vocab:
        candidates = candidates.filter(_has_only(tokens, word_values(vocab)))
    if inline_marked and inline_vocab:
        return candidates

    # Two steps: in one, Spark would take the digest again for every exploded word.
    candidates = candidates.withColumn("text_digest", F.sha2(F.col(text), 256))
    kept = candidates
    if not inline_marked:
        hits = _words(kept, tokens).join(_frame(spark, marked), F.col("word") == F.col("listed"), "left_semi")
        kept = kept.join(hits.select("text_digest"), "text_digest", "left_semi")
    if not inline_vocab:
        known = _frame(spark, vocab)
        unknown = _words(kept, tokens).distinct().join(known, F.col("word") == F.col("listed"), "left_anti")
        kept = kept.join(unknown.select("text_digest"), "text_digest", "left_anti")
    return kept.select(*df.columns)


def flag(
    df: DataFrame,
    marked: Words,
    vocab: Words,
    asof: dt.datetime,
    sender: str = "sender",
    text: str = "message",
    fold: str = "upper",
    **inline: bool,
) -> DataFrame:
    """Flagged messages as (employee_id, start_date)."""
    return keep_flagged(df, marked, vocab, text, fold, **inline).select(
        F.col(sender).cast("string").alias("employee_id"), moment(asof).alias("start_date")
    )
