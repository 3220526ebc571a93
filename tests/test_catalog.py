"""Every catalog query against its SQL on the small tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from sightline.plans import catalog, extra, more  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no driver tables here")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, bool) or v is None:
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return float(v) if isinstance(v, int) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_matches_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    ref = duck.execute(catalog.SQL[name])
    names = [d[0] for d in ref.description]
    assert sorted(got.columns) == sorted(names)
    want = sorted((tuple(map(plain, r)) for r in ref.fetchall()), key=repr)
    have = sorted((tuple(map(plain, r)) for r in got.select(*names).collect()), key=repr)
    assert have == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
