"""Ball k-means against plain k-means over all distances."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obsmill.llm import queries, vector_codes

SF = "/root/testdata/sf0.001"
SHAPE = "vec_id long, embedding array<double>, label int, a string, error int"


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 60), st.integers(1, 9))
def test_balls_find_the_nearest(seed, n, entries):
    rng = np.random.default_rng(seed)
    x, book = rng.integers(-4, 5, (n, 3)), rng.integers(-4, 5, (entries, 3))
    best, least = vector_codes.nearest(x, rng.integers(0, entries, n), book)
    d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    assert best.tolist() == d.argmin(axis=1).tolist() and least.tolist() == d.min(axis=1).tolist()


def plain(ids, vectors, labels, parts=8, entries=16):
    x = np.floor(np.array(vectors, float) * 4096).astype(np.int64).reshape(len(ids), parts, -1)
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, list(vectors[i])))[:entries]
    books = x[order].transpose(1, 0, 2).copy()
    codes = lambda: np.stack([((x[:, p, None] - books[p][None]) ** 2).sum(axis=2).argmin(axis=1) for p in range(parts)], axis=1)
    for _ in range(6):
        a = codes()
        for p in range(parts):
            for e in set(a[:, p].tolist()):
                books[p, e] = x[a[:, p] == e, p].sum(axis=0) // (a[:, p] == e).sum()
    a = codes()
    error = sum(((x[:, p] - books[p][a[:, p]]) ** 2).sum(axis=1) for p in range(parts)).tolist()
    by = {}
    for k, e in zip(labels, error, strict=True):
        by[k] = by.get(k, 0) + e
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in row), e, by[k], sha) for i, row, e, k in zip(ids, a.tolist(), error, labels, strict=True)), key=str)


def coded(df):
    rows, books = vector_codes.compress(df)
    sha = vector_codes.codebooks_sha256(books)
    return sorted(((r.id, r.code.hex(), r.error, r.label_error, sha) for r in vector_codes.label_errors(rows).collect()), key=str)


def test_query_on_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = plain([r.vec_id for r in rows], [r.embedding for r in rows], [r.label for r in rows])
    got = [(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in queries.op13_vector_codes(spark, SF).collect()]
    assert sorted(got, key=str) == want


def test_edges(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=16).round(1).tolist(), None if i % 4 == 0 else 1) for i in range(40)]
    good += [good[3], (3, good[5][1], 7), (None, good[2][1], 7)]
    bad = [(90, None, 1), (91, [], 1), (92, [None] + [0.0] * 15, 1), (93, [float("nan")] * 16, 1), (94, [float("-inf")] * 16, 1), (95, [0.0] * 8, 1)]
    df = spark.createDataFrame([(*r, "clash", 5) for r in good + bad], SHAPE).repartition(3)
    assert coded(df) == plain(*zip(*good, strict=True))


def test_few_rows_empty_table_and_limits(spark):
    few = [(i, [i / 7] * 8, 1) for i in range(3)] * 2
    assert coded(spark.createDataFrame([(*r, "", 0) for r in few], SHAPE)) == plain(*zip(*few, strict=True))
    empty, books = vector_codes.compress(spark.createDataFrame([], SHAPE))
    assert vector_codes.label_errors(empty).collect() == [] and books.size == 0
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([(1, [0.5] * 9, 1, "", 0)], SHAPE))
    with pytest.raises(ArithmeticError):
        vector_codes.scaled([[1e9] * 8], 4096)
