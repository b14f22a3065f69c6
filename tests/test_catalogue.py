"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from tilealg.plans import catalogue

from .conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(x):
    if isinstance(x, float) and math.isnan(x):
        return "nan"
    return x


def _key(row):
    return tuple(str(_norm(v)) for v in row)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    """Of the catalogue; the training-data queries are tested in tests/llm."""
    assert set(catalogue.ORACLE) == set(catalogue.QUERIES)
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(catalogue.ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["i", "j", "v"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SMALL)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    exp = sorted((tuple(_norm(r[rel.columns.index(c)]) for c in cols) for r in rel.fetchall()),
                 key=_key)
    assert got == exp
