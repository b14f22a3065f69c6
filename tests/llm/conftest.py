import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang[, source]]) tuples."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def clashing():
    """Adds columns whose names the operators use inside."""
    names = ["rid", "key", "row", "n", "size", "piece", "parcel", "shard", "_part", "_lang", "level", "name", "comp",
             "items", "host", "id", "k", "first"]

    def add(df):
        return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    return add
