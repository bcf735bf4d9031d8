"""Near duplicates of the pipeline against all pairs."""

import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline
from obsmill.llm import simhash, similar

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_force(rows):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted({find(i) for i in sets})


def changed(rng, words, n):
    out = list(words)
    for k in rng.choice(len(words) // 5, n, replace=False):
        out[5 * k + 2] = f"x{rng.integers(1 << 40)}"
    return out


def copies():
    rng = np.random.default_rng(5)
    passage, rows = [f"p{i}" for i in range(40)], []
    for _ in range(3):
        base = [f"w{i}" for i in rng.integers(0, 1 << 30, 300)]
        for n in (0, 3, 5, 6, 7, 8, 20):
            rows += [changed(rng, base, n), passage + changed(rng, base, n)]
    chain = [f"c{i}" for i in range(200)]
    rows += [chain[4 * k :] + [f"d{i}" for i in range(4 * k)] for k in range(12)]
    rows += [passage + [f"q{i}"] * 3 for i in range(6)]
    return [(i, " ".join(w)) for i, w in enumerate(rows)] + [(900, None), (901, " \n"), (902, "a b"), (903, "A  b"), (904, "b a")]


@pytest.mark.parametrize("rounds", [0, 3])
def test_against_all_pairs(spark, rounds, monkeypatch):
    monkeypatch.setattr(similar, "ROUNDS", rounds)
    rows = copies()
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.near_duplicates(spark, docs, DATA).collect()
    assert sorted(r["doc_id"] for r in kept) == brute_force(rows)
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_documents_against_all_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(r["doc_id"] for r in similar.drop_near_duplicates(docs).collect()) == brute_force(rows)


def test_edges(spark):
    rows = [(None, "one two three four five six", "en", "a", 1), (4, "the cat " * 20000, "en", "a", 1), (4, "the cat " * 20000, "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert similar.drop_near_duplicates(docs).count() == 2
    assert similar.drop_near_duplicates(docs.limit(0)).count() == 0


def test_fingerprints_meet(spark):
    """All pairs up to eleven bits of 128 meet, whichever bits differ; ten values each way at random and spread over the segments."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(40):
        base = rng.integers(0, 2, 128)
        for n in range(12):
            other = base.copy()
            places = rng.permutation(128)[:n] if k % 2 else np.array([32 * (j % 4) + j // 4 for j in range(n)], int)
            other[places] ^= 1
            rows.append((k, n, *(np.packbits(x).view(np.int64).tolist() for x in (base, other))))
    df = spark.createDataFrame(rows, "k int, n int, a array<long>, b array<long>")
    got = df.select("n", simhash.distance("a", "b").alias("bits"), simhash.near_segments("a").alias("x"), simhash.near_segments("b").alias("y")).collect()
    assert all(r["bits"] == r["n"] and set(r["x"]) & set(r["y"]) and len(set(r["x"])) == 4 * 33 for r in got)


def test_links_by_fingerprints(spark, monkeypatch):
    """Without the exact way for the rest, copies with few changes still link; no other texts do."""
    monkeypatch.setattr(similar, "prefix_pairs", lambda prefixes, *_: prefixes.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0))
    rng, rows = np.random.default_rng(9), []
    for _ in range(20):
        base = [f"w{i}" for i in rng.integers(0, 1 << 30, 300)]
        rows += [" ".join(changed(rng, base, n)) for n in (0, 1, 1, 2)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(rows)], SCHEMA)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, DATA).collect())
    assert kept == list(range(0, 80, 4)) == brute_force([*enumerate(rows)])


def test_pairs_of_a_large_group(spark, monkeypatch):
    """What links already hold together isn't compared again: pairs are a few for each copy, not dozens."""
    rng, compared, verified = np.random.default_rng(1), [], similar.verified
    base = [f"b{i}" for i in rng.integers(0, 1 << 30, 150)]
    rows = [(i, " ".join(changed(rng, base, 1 + i % 3))) for i in range(400)]
    monkeypatch.setattr(similar, "verified", lambda pairs, *more: compared.append(pairs.count()) or verified(pairs, *more))
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, DATA).collect())
    assert kept == brute_force(rows)
    assert 0 < sum(compared) < 20 * len(rows), compared


def test_segments(spark):
    """A fingerprint's segments are among the values that its near segments are looked up by, each with its number."""
    df = spark.createDataFrame([([-1, 0, 5 << 32 | 7],)], "fp array<long>")
    got = df.select(simhash.segments("fp").alias("x"), simhash.near_segments("fp").alias("y")).first()
    assert got["x"] == [0xFFFFFFFF, 1 << 32 | 0xFFFFFFFF, 2 << 32, 3 << 32, 4 << 32 | 5, 5 << 32 | 7]
    assert [got["y"][33 * k] for k in range(6)] == got["x"]
