"""Every registered query of the panel operators against its SQL in DuckDB."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest
from tessellate.plans import catalog

SF = "/root/testdata/sf0.001"
#: Queries whose right answer on these tables is no row.
MAY_BE_EMPTY = {"i02_i06_ic_statistics"}  # ten entities are too few


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if v is None or v is pd.NaT or isinstance(v, float) and np.isnan(v):
        return "~"
    if isinstance(v, (bool, np.bool_, int, float, np.integer, np.floating)):
        return round(float(v), 9) + 0.0
    return str(v)


def rows(df, columns):
    df = df[columns].copy()
    for c in columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype(str).replace("NaT", "~")
        df[c] = df[c].map(plain)
    return sorted(df.itertuples(index=False, name=None), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(name, spark, duck):
    ours = catalog.QUERIES[name](spark, SF).toPandas()
    theirs = duck.sql(catalog.ORACLE_SQL[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    assert len(ours) or name in MAY_BE_EMPTY, "two empty tables prove nothing"
    assert rows(ours, columns) == rows(theirs, columns)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_without_sql_runs(name, spark):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry_point(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == ["entity", "session", "ret_4", "cs_rank_ret_4"]
