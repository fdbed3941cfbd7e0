"""Threshold-scaled sketches: every shingle hash below a fixed fraction of the range is kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import picked, settings, staged

# Fixed value: words are separated by runs of these.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = 5


def with_sketch(df: DataFrame, text: str, name: str, fraction: float = 0.25, n: int = WORDS) -> DataFrame:
    """df with the array column `name`: the sketch of the whole text, ascending numbers of 63 bits.

    The hashes of all shingles of n words (XXH64; fewer words make one shingle) that lie below
    `fraction` of the range are kept, each once, so a sketch grows with its text. If a text has
    words but no hash that low, its smallest hash stands in. No words, or null: an empty array.
    """
    limit = int(fraction * 2**63) - 1
    words, hashes = f"{name} words", f"{name} hashes"
    split = F.filter(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), SPACES), lambda w: w != "")
    df = df.withColumn(words, split)
    shingle = lambda i: F.xxhash64(*[F.get(F.col(f"`{words}`"), i + k) for k in range(n)])
    starts = F.sequence(F.lit(0), F.greatest(F.size(f"`{words}`") - n, F.lit(0)))
    all_hashes = F.transform(starts, lambda i: F.shiftrightunsigned(shingle(i), 1))
    df = df.withColumn(hashes, F.when(F.size(f"`{words}`") > 0, all_hashes).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn(name, F.array_sort(F.array_distinct(F.filter(f"`{hashes}`", lambda h: h <= limit))))
    least = F.filter(F.array(F.array_min(f"`{hashes}`")), lambda h: h.isNotNull())
    return df.withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(least)).drop(words, hashes)


def merged(a: Column, b: Column, fraction: float = 0.25) -> Column:
    """The sketch of two texts together, from their sketches: a union, without stand-ins if it has more."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda h: h <= int(fraction * 2**63) - 1)
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def containment(a: Column, b: Column) -> Column:
    """Which part of a's shingles b has, as its sketch tells; two empty ones contain each other."""
    shared = F.size(F.array_intersect(a, b)) / F.nullif(F.size(a), F.lit(0))
    return F.coalesce(shared, F.when(F.size(b) == 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def resemblance(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity of the shingle sets."""
    shared = F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0))
    return F.coalesce(shared, F.lit(1.0))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), ",")


def successors(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct rows with next_<key> for each key: the next row by the keys, after the last the first.

    Rows are dealt by key ranges and put in order within each; only the first row of each
    range, one per partition, is looked at together.
    """
    ordered = staged(rows.distinct().repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranges")
    row = F.struct(*keys)
    first = ordered.groupBy("_range").agg(F.min(row).alias("_first"))
    ring = Window.orderBy("_range")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = first.select("_range", F.coalesce(F.lead("_first").over(ring), F.first("_first").over(whole)).alias("_onward"))
    ahead = F.lead(row).over(Window.partitionBy("_range").orderBy(*keys))
    found = ordered.withColumn("_ahead", ahead).join(F.broadcast(first), "_range")
    after = F.coalesce("_ahead", "_onward")
    return found.select(*rows.columns, *[after[k].alias(f"next_{k}") for k in keys])


def with_edits(docs: DataFrame, id: str = "doc_id", text: str = "text", fraction: float = 0.25) -> DataFrame:
    """Sketches of each text and of its edited text, and how alike they are.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document by ascending id; after the last comes the
    first. Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next (the part of the text's shingles that the edited and the next text contain), and
    resemblance_edited and resemblance_next (Jaccard).

    A null text counts as empty; null ids come first; rows with the same id follow each other
    by the hash of their texts, and rows that repeat id and text are one document in that
    order, returned as often as they occur. A single document follows itself. Other columns
    are ignored; an empty table gives no rows.
    """
    rows = picked(docs, *dict.fromkeys([id, text])).select(
        F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("hash", F.xxhash64("text"))
    with settings(docs.sparkSession):
        sizes = rows.select("id", "hash", F.length("text").cast("long").alias("n_chars"))
        order = staged(successors(sizes, ["id", "hash"]), "order")

    def keyed(side: str, id_column: str, hash_column: str) -> list[Column]:
        """A key without nulls, so that both joins and the folding of repeats share one exchange."""
        return [
            F.col(id_column).isNull().alias(f"{side}_none"),
            F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias(f"{side}_key"),
            F.col(hash_column).alias(f"{side}_hash"),
        ]

    def same(a: str, b: str) -> Column:
        return (F.col(f"{a}_none") == F.col(f"{b}_none")) & (F.col(f"{a}_key") == F.col(f"{b}_key")) & (F.col(f"{a}_hash") == F.col(f"{b}_hash"))

    # Only keys and text, and nothing computed: then both joins read one exchange of the texts.
    base = rows.select("text", *keyed("own", "id", "hash"))
    giver = order.select(
        "id", *keyed("to", "id", "hash"), *keyed("from", "next_id", "next_hash"), F.expr("int(n_chars div 2)").alias("wanted")
    )
    given = base.join(giver, same("own", "from")).withColumn("tail", F.expr("substring(text, 1, wanted)"))
    given = with_sketch(given, "text", "next_sketch", fraction)
    given = given.select("id", "to_none", "to_key", "to_hash", "tail", "next_sketch").dropDuplicates(["to_none", "to_key", "to_hash"])
    joined = base.join(given, same("own", "to")).withColumn("n_chars", F.length("text").cast("long"))
    head = F.expr("substring(text, 1, int(n_chars - n_chars div 2))")
    joined = with_sketch(joined.withColumn("edited", F.concat(head, F.col("tail"))), "text", "sketch", fraction)
    done = with_sketch(joined, "edited", "edited_sketch", fraction)
    return done.select(
        F.col("id").alias(id), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("resemblance_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("resemblance_next"),
    )
