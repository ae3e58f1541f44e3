import pytest


@pytest.fixture(scope="session")
def corpus(spark):
    """Builder of a documents table: lists of texts with ids from 0, or whole rows."""

    def make(texts, ids=None, sources=None, langs=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, (langs or ["en"] * len(texts))[k], (sources or ["s"] * len(texts))[k], len(t or "")) for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make


#: Names that the operators use inside must not clash with columns of the input.
CLASHING = ["rid", "blob", "row", "rows", "size", "slice", "key", "hash", "part", "ids", "fingerprint", "node", "score", "pattern", "kept", "before"]


@pytest.fixture
def clash():
    from pyspark.sql import functions as F

    return lambda df: df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
