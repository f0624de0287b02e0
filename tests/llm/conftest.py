import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names the operators use themselves
        T.StructField("id", T.StringType()),
        T.StructField("h", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("text_hash", T.StringType()),
        T.StructField("odd name.x", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table (with extra columns) from (id, text[, lang, source])."""

    def make(rows):
        full = []
        for r in rows:
            i, t, lang, source = (*r, *(None,) * (4 - len(r)))
            full.append((i, t, lang, source, None if t is None else len(t), "x", "y", "z", "k", "t", "o"))
        return spark.createDataFrame(full, DOCS)

    return make


WORDS = "alder birch cedar dogwood elm fir ginkgo hazel ivy juniper kapok larch maple nutmeg oak pine quince rowan spruce teak".split()


@pytest.fixture(scope="session")
def prose():
    """``prose(seed, n)``: n pseudo-random words."""
    import random

    def make(seed, n):
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) + r.choice(["", "a", "en", "ly"]) for _ in range(n))

    return make
