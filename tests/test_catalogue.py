"""Every catalogue query against its DuckDB counterpart on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from graphspark.plans import catalogue

SF = "/root/testdata/sf0.001"


def _rows(frame: pd.DataFrame) -> list[str]:
    plain = lambda v: None if pd.isna(v) else int(v) if isinstance(v, float) and v == int(v) else v
    return sorted(repr([plain(v) for v in r]) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    got, want = catalogue.queries()[name](spark, SF).toPandas(), con.execute(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
