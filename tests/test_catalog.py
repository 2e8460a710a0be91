"""Every registered query that has SQL gives DuckDB's rows, and every other one runs."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = entry.catalog.queries(), entry.catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return c


def plain(df):
    show = lambda v: "NULL" if v is None or v is pd.NaT or v is pd.NA or v != v else repr(float(v)) if isinstance(v, float) else str(v)
    columns = sorted(df.columns)
    return sorted(tuple(show(v) for v in row) for row in df[columns].astype(object).itertuples(index=False)), columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name in ORACLE:
        want = duck.execute(ORACLE[name]).df()
        for c in got.columns:  # whole numbers that come as floats where a column has nulls
            if got[c].dtype == "float64" and c in want and str(want[c].dtype).lower().startswith("int"):
                got[c] = got[c].astype("Int64")
        assert plain(got) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() == 1 and set(entry.oracle_sql()) <= set(entry.queries())
