"""Every query of the library against its oracle, over the smallest tables."""

import math
from decimal import Decimal
from pathlib import Path

import pytest

from quarterdeck.plans.queries import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the tables are not here")


@pytest.fixture(scope="module")
def connection():
    c = duckdb.connect()
    for t in Path(SF).glob("*.parquet"):
        c.execute(f"create view {t.stem} as select * from '{t}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return int(v) if v == int(v) else round(float(v), 6)
    return v.replace(tzinfo=None) if getattr(v, "tzinfo", None) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = connection.execute(ORACLES[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert got == want
