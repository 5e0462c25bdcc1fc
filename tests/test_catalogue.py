"""Every query with SQL gives the rows of that SQL on DuckDB."""

import glob
import os

import duckdb
import pytest

from docloom import catalogue


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def _rows(df, cols):
    return sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, duck, sf, name):
    got, want = catalogue.queries()[name](spark, sf).toPandas(), duck.sql(catalogue.oracle_sql()[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert _rows(got, cols) == _rows(want, cols)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
