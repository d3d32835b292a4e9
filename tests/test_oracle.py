"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from waymark.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no driver tables")


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    names = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in names)) for r in df.collect())
    cursor = duck.execute(catalogue.oracle_sql()[name])
    have = [d[0] for d in cursor.description]
    assert sorted(have) == names
    place = [have.index(c) for c in names]
    want = sorted(repr(tuple(plain(r[k]) for k in place)) for r in cursor.fetchall())
    assert got == want


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 25 and df.columns[0] == "scene"


def test_sql_has_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
