"""Each query against its SQL on the smallest tables."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from obsmill import queries as q
from obsmill import clean_queries, fleet_queries, publication_queries, report_queries, rule_queries, summary_queries  # noqa: F401 - they register their queries with the others

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return float(x) if isinstance(x, (float, int)) and not isinstance(x, bool) else str(x)


def order(row):
    return [(x is None, 0 if x is None else round(x, 3) if isinstance(x, float) else x) for x in row]


def close(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6))


@pytest.mark.parametrize("name", sorted(q.SQL))
def test_same_rows(spark, duck, name):
    df = q.QUERIES[name](spark, DATA)
    got = duck.execute(q.SQL[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect()), key=order)
    theirs = sorted((tuple(plain(dict(zip(columns, r))[c]) for c in sorted(columns)) for r in got.fetchall()), key=order)
    assert len(ours) == len(theirs)
    assert [(a, b) for a, b in zip(ours, theirs) if not all(map(close, a, b))] == []
