"""Every catalogue query against its DuckDB oracle, on sf0.001 (whole tables)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from spacetime.plans.catalog import ORACLE_SQL, QUERIES

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return c


def norm(rows):
    out = []
    for r in rows:
        out.append(tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE_SQL) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, D)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(entry_mod.oracle_sql()[name])
    assert df.columns == rel.columns
    want = [tuple(r) for r in rel.fetchall()]
    assert norm(got) == norm(want)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["x", "y", "z"] and 0 < len(rows) <= 50
