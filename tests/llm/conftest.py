import pytest


@pytest.fixture(autouse=True)
def workers(spark):
    from rosterline.llm.staging import importable

    importable(spark)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def awkward(spark):
    """Null, empty, repeated, tied and very long texts, and columns with clashing names."""
    long = "lorem ipsum dolor " * 20_000
    rows = [
        (1, None, "en", None), (2, "", "en", "a"), (3, "", "en", "a"), (None, "no id at all", "en", "b"), (4, "one two three four", None, "b"),
        (4, "one two three four", None, "b"), (5, "one two three four", "x", "c"), (6, long, "x", "c"), (7, " \t\n ", "x", None),
        (8, "é ñ 漢字 \U0001F600", "x", "é"), (None, None, None, None),
    ]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clashes = ("id", "size", "print", "label", "node", "score", "predicted", "hash", "pseudonyms", "row", "start", "length", "_shard", "n_chars")
    return base.selectExpr("*", *[f"'clash' as `{c}`" for c in clashes])
