import glob
import os

import duckdb
import pytest

import __spark_entry__
from quarrylog.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(frame):
    def plain(x):
        return "" if x is None or x != x else round(float(x), 6) if isinstance(x, int | float) and not isinstance(x, bool) else str(x)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(plain(x) for x in r) for r in frame.where(frame.notna(), None).itertuples(index=False)), key=str)


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_matches_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    want = duck.execute(catalogue.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
