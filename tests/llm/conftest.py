import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("_key", T.StringType()),
        T.StructField("words", T.LongType()),
        T.StructField("kept", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, None, None if k % 3 == 0 else "s", None, "x", 1, "y") for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture(scope="session")
def odd(make_docs):
    """Nulls, empty and long texts, ties, repeated rows."""
    words = [f"w{i % 97}x{i % 89}" for i in range(30_000)]
    texts = [None, "", " \t\n", "a", " ".join(words), " ".join(words), "é" * 300, "é" * 300, "x " * 200, "x " * 100, "one two three four", "one  two\tthree four"]
    return make_docs(texts + texts[4:5], [3, 1, None, None, 7, 7, 8, 9, 10, 11, 12, 13, 7])
