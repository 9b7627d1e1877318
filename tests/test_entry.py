"""Driver contract: entry(), queries() and oracle_sql() line up; every query
of the library is compared with its oracle at sf0.001."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from segmetrics.plans.catalog import QUERIES

from conftest import SF001


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["segment_id", "user_count", "error_reason"]
    assert df.count() == 300


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    """Comparable text: null, 6-decimal floats, ISO dates without midnight."""
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "<null>"
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else f"{v:.6f}"
    if hasattr(v, "isoformat"):
        text = v.isoformat()
        return text[:-9] if text.endswith("T00:00:00") else text
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle_matches_sf0001(spark, name):
    con = duckdb.connect()
    for t in ["customer", "nation", "orders", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    odf = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(odf.columns) == cols
    want = sorted(tuple(_norm(None if (isinstance(x, float) and math.isnan(x)) else
                              (x.item() if hasattr(x, "item") else x)) for x in row)
                  for row in odf[cols].itertuples(index=False))
    assert got == want
