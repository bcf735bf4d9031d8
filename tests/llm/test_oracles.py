"""Queries of this subpackage that have SQL, against it."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from obsmill.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_same_rows(spark, name, size):
    data, con = f"/root/testdata/{size}", duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    theirs = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in theirs.description]
    ours = queries.queries()[name](spark, data)
    assert sorted(columns) == sorted(ours.columns)
    assert sorted(tuple(r) for r in ours.select(*columns).collect()) == sorted(theirs.fetchall())
