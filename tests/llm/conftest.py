import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """documents rows from (doc_id, text)."""

    def make(*rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd(docs, spark):
    """Nulls, empty and long texts, repeated rows, clashing extra columns."""
    from pyspark.sql import functions as F

    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one two three four five six"),
        (4, "one two three four five six"),
        (None, "one two three four five six"),
        (None, None),
        (5, "Long words of a long text, " * 20_000),
        (6, "é 漢字 \x00 <|endoftext|> a  b"),
    ]
    names = ("text_hash", "n", "words", "row", "spans", "tokens", "part", "start", "slot", "score", "file", "component", "size", "shard", "length", "found")
    return docs(*rows).withColumns({name: F.lit(name) for name in names})


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
