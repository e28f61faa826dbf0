"""Every query that has SQL gives the rows that DuckDB gives on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from larkspur.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def canonical(df):
    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return "null"
        if isinstance(v, float):
            return f"{v:.9g}"
        return str(pd.Timestamp(v)) if hasattr(v, "year") else f"{v:.9g}" if hasattr(v, "dtype") and v.dtype.kind in "fiu" else str(v)

    return sorted(tuple(text(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows(spark, con, name):
    got, want = registry.QUERIES[name](spark, DATA).toPandas(), con.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).columns
