import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    T.StructField("key", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", T.StringType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table, with columns of clashing names, from (doc_id, text) pairs."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 0.5, "x") for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, white space, repeated rows, other scripts."""
    long = " ".join(f"word{k % 977}x{k % 31}" for k in range(30_000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, long), (7, "one two"), (7, "one two"), (None, "no id here at all"),
        (8, "Ünïcode 中文 🙂 don't  stop\n\n'll\x1c <|endoftext|> 12345 ½"), (9, "A" * 5_000),
    ]
