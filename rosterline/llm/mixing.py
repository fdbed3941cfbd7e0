"""Mixing sources to target weights: blocks of equal word counts, apportioned by Sainte-Laguë."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import picked, settings, staged

# Fixed value: a word is a run of characters other than space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
# Words to a block: a source's share is exact to about half a block for each of its shards.
BLOCK_WORDS = 8
# A source has as many shards as the root of its words divided by this: neither the shards of
# a source nor the documents of a shard, which one task puts in order, grow like the input.
SHARD_SCALE = 1 << 10


def seeded(seed: int, *values: Column) -> Column:
    """A number of 48 bits from the MD5 of the values and the seed; nulls count as a word."""
    parts = [F.coalesce(v.cast("string"), F.lit("null")) for v in values]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts, F.lit(str(seed)))), 1, 12), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...], growth: float, most: float) -> DataFrame:
    """sources (source, source_size) with `place` (code-point order from 1, null last) and `target`.

    The targets share `growth` times all sizes by the weights, given in turn by place, and none
    is above `most` times its source's size: what is beyond is shared anew among the others.
    With sources in order of cap / weight, the level at which the remaining share meets the
    remaining weights is highest exactly where the first source stays below its cap.
    The windows run over one row per source.
    """
    place = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    rows = sources.withColumn("place", F.row_number().over(place)).withColumn(
        "weight", F.element_at(turn, ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    )
    rows = rows.withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy("ratio", "place")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    share = growth * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", share / F.sum("weight").over(after))
    rows = rows.withColumn("level", F.max("level").over(whole))
    return rows.select("source", "source_size", "place", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def sainte_lague(parts: DataFrame, group: list[str], order: str, weight: str, seats: str) -> DataFrame:
    """parts with `quota`: the seats of its group given to the highest quotients weight / (2k - 1).

    Ties go to the smaller `order`. Between two divisors that are surely too high and too low
    all seats but a few per part are known, so only those are listed and ranked.
    """
    window = Window.partitionBy(*group)
    rows = parts.withColumn("_n", F.count_if(F.col(weight) > 0).over(window))
    rows = rows.withColumn("_rate", F.col(weight) / F.nullif(F.sum(weight).over(window), F.lit(0)))
    seat = lambda n: F.floor((F.col("_rate") * n + 1) / 2)
    rows = rows.withColumn("_low", F.coalesce(F.greatest(F.lit(0), seat(2 * F.col(seats) - F.col("_n")) - 1), F.lit(0)))
    rows = rows.withColumn("_high", F.coalesce(seat(2 * F.col(seats) + F.col("_n")) + 1, F.lit(0)))
    rows = rows.withColumn("_open", F.col(seats) - F.sum("_low").over(window))
    listed = rows.filter(F.col(weight) > 0).select(
        *group, order, "_open", weight, F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_k")
    )
    best = window.orderBy((F.col(weight) / (2 * F.col("_k") - 1)).desc(), order)
    won = listed.withColumn("_rank", F.row_number().over(best)).filter("_rank <= _open")
    won = won.groupBy(*group, order).agg(F.count("*").alias("_won"))
    joined = rows.join(won, [*group, order], "left")
    quota = (F.col("_low") + F.coalesce("_won", F.lit(0))).cast("long").alias("quota")
    return joined.select(*parts.columns, quota)


def _overlap(low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.col("_end"), high) - F.greatest(F.col("_start"), low))


def mix(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[float, ...] = (3, 1, 2), growth: float = 1.5, most: float = 2.0, seed: int = 42,
    keep: tuple[str, ...] = (), shard_scale: int = SHARD_SCALE,
) -> DataFrame:
    """A row for each row of docs: id, size, source_size, target, taken, copies, cuts and the columns of `keep`.

    size counts the words of the text (null: none), target is the words its source should give
    (see `targets`), taken the words this document gives, repeats counted. The documents of a
    source are dealt to shards by a seeded hash and put in a seeded order; their words in that
    order are cut into blocks. Sainte-Laguë gives each source its blocks, and each shard its
    part of them; the shard then gives all its blocks as often as the quota covers, and of the
    rest a run of blocks that begins at a seeded one and goes on around the end. So a document
    is given whole but at the ends of a run: copies says how often it is given whole, cuts
    which runs of words besides (from, to; word 0 is the first). No document gives more than
    twice its size. Reruns agree.

    A null source is a source of its own, the last. Documents without words take nothing and
    change nothing. Repeated rows are separate documents. No words at all, or an empty table:
    all targets are zero, or no rows. Null ids are ids like others.
    """
    spark = docs.sparkSession
    kept = [f"keep_{i}" for i in range(len(keep))]
    rows = picked(docs, *dict.fromkeys([id, text, source, *keep])).select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"),
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)],
    )
    with settings(spark):
        sizes = staged(rows.drop(*kept), "sizes")
        if not keep:
            rows = sizes
        known = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, growth, most)
        blocks = F.round(F.sum("target").over(Window.partitionBy(F.lit(1))) / BLOCK_WORDS).cast("long")
        known = sainte_lague(known.withColumn("_all", F.lit(1)).withColumn("seats", blocks), ["_all"], "place", "target", "seats")
        shards = F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("source_size") / shard_scale))).cast("long")
        known = staged(known.select("source", "source_size", "place", "target", "quota", shards.alias("_shards")), "sources")

        def dealt(frame: DataFrame) -> DataFrame:
            frame = frame.withColumn("_order", seeded(seed, F.col("id")))
            frame = frame.join(known.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
            return frame.withColumn("_shard", F.col("_order") % F.col("_shards"))

        shard = dealt(sizes).groupBy("place", "_shard").agg(F.sum("size").alias("_words"), F.first("quota").alias("seats"))
        shard = sainte_lague(shard, ["place"], "_shard", "_words", "seats").drop("seats")
        n = F.ceil(F.col("_words") / BLOCK_WORDS).cast("long")
        shard = shard.withColumn("_n", n).withColumn("_given", F.least("quota", 2 * F.col("_n"))).filter("_n > 0")
        shard = shard.select(
            F.col("place").alias("_place"), F.col("_shard").alias("_own"), "_words", "_n",
            F.expr("_given div _n").alias("_copies"), (F.col("_given") % F.col("_n")).alias("_rest"),
            (seeded(seed, F.col("place"), F.col("_shard")) % F.col("_n")).alias("_first"),
        )
        shard = staged(shard, "shards")
    order = Window.partitionBy("place", "_shard").orderBy("_order", "id", "size")
    line = dealt(rows).withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    line = line.withColumn("_start", F.col("_end") - F.col("size"))
    line = line.join(shard, (F.col("place") == F.col("_place")) & (F.col("_shard") == F.col("_own")), "left")
    last = F.col("_first") + F.col("_rest")
    runs = [
        (F.col("_first") * BLOCK_WORDS, F.least(last * BLOCK_WORDS, "_words")),
        (F.lit(0), F.greatest(F.lit(0), last - F.col("_n")) * BLOCK_WORDS),
    ]
    given = [F.coalesce(_overlap(low, high), F.lit(0)).cast("long") for low, high in runs]
    cuts = F.array(*[
        F.struct((F.greatest("_start", low) - F.col("_start")).cast("long").alias("from"),
                 (F.least("_end", high) - F.col("_start")).cast("long").alias("to"))
        for low, high in runs
    ])
    copies = F.coalesce("_copies", F.lit(0))
    return line.select(
        F.col("id").alias(id), "size", "source_size", "target",
        (copies * F.col("size") + given[0] + given[1]).cast("long").alias("taken"),
        copies.cast("long").alias("copies"), F.filter(cuts, lambda c: c["to"] > c["from"]).alias("cuts"),
        *[F.col(k).alias(f"keep.{c}") for c, k in zip(keep, kept, strict=True)],
    )


def mixed_rows(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows that `mix` gives, with the columns of docs: a row per whole copy and per run of words.

    The text of a run is its words joined by spaces; a column n_chars is counted anew.
    """
    mixed = mix(docs, id, text, source, keep=tuple(docs.columns), **options)
    body = F.col(f"`keep.{text}`")
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    run = lambda c: F.array_join(F.slice(words, (c["from"] + 1).cast("int"), (c["to"] - c["from"]).cast("int")), " ")
    cut = F.when(F.size("cuts") > 0, F.transform("cuts", lambda c: F.when(c["to"] - c["from"] == F.col("size"), body).otherwise(run(c))))
    texts = F.concat(F.array_repeat(body, F.col("copies").cast("int")), F.coalesce(cut, F.array().cast("array<string>")))
    mixed = mixed.filter("taken > 0").withColumn("new text", F.explode(texts))
    new = {text: F.col("new text"), "n_chars": F.length("new text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return mixed.select(*[new.get(c, F.col(f"`keep.{c}`")).alias(c) for c in docs.columns])
