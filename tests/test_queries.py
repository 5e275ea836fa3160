"""Every registered query against its SQL in DuckDB on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

from loomset.plans import load

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
REGISTRY = load()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(REGISTRY.QUERIES))
def test_query(spark, db, name):
    frame = REGISTRY.QUERIES[name](spark, SF)
    cols = sorted(frame.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in frame.collect())
    if name not in REGISTRY.SQL:
        assert got
        return
    cursor = db.execute(REGISTRY.SQL[name])
    head = [d[0] for d in cursor.description]
    assert sorted(head) == cols
    assert got == Counter(tuple(plain(r[head.index(c)]) for c in cols) for r in cursor.fetchall())
