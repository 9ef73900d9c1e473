"""The corpus queries against their SQL, at the smallest scale."""

import duckdb
import pytest
from tessellate.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(name, spark):
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    theirs = duck.sql(queries.ORACLE_SQL[name])
    ours = queries.QUERIES[name](spark, DATA)
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = sorted(ours.columns)
    assert sorted(map(tuple, ours.select(*columns).collect())) == sorted(theirs.select(*columns).fetchall())
