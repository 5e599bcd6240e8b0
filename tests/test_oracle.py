"""Every core query with SQL against DuckDB, and the rest for a stable schema, on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from gleaner.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def plain(v):
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(plain(x) for x in v)
    if pd.isna(v):
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool":
        return bool(v)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, (int, float)) or type(v).__name__.startswith(("int", "uint", "float")):
        return round(float(v), 6)
    return v


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(plain(v) for v in r) for r in df.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_as_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    want = duck.execute(registry.ORACLE[name]).fetch_df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE) - {"r150_stream_dedup_refreshing"}))
def test_runs(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 0
