import duckdb
import pytest

from spacetime.llm.catalog import ORACLE_SQL, QUERIES

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    df = QUERIES[name](spark, D)
    rel = con.sql(ORACLE_SQL[name])
    assert df.columns == rel.columns
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())
