"""The entry module: queries agree with their SQL on the smallest tables, and need no training-text package."""

import glob
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def table(df):
    def plain(v):
        if v is None or v != v:
            return "∅"
        if isinstance(v, float):  # integers with nulls arrive as floats
            return str(int(v)) if v == int(v) else str(round(v, 6))
        return str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(plain(v) for v in r) for r in df.astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n not in ("extract_lists", "result_counts")] + ["extract_lists"])
def test_query_agrees_with_its_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    import pandas as pd

    clean = lambda df: df.astype(object).where(pd.notna(df), None)
    assert table(clean(got)) == table(clean(want))


def test_flagship(spark):
    assert entry.entry(spark).columns == ["doc_id", "kind", "key", "value", "page_number", "source_line", "pos"]
