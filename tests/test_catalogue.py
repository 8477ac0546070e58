import math
import os

import duckdb
import pytest

import __spark_entry__
from strataquarry.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


def norm(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else float(v) if hasattr(v, "quantize") else v


def ordered(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(norm(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_its_sql(spark, name):
    df = catalogue.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert ordered(rows, df.columns) == ordered(want.fetchall(), want.columns)


def test_entry_points(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
