"""Tokenizer alignment against overlaps of all token pairs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from obsmill.llm import alignment, queries

SF = "/root/testdata/sf0.001"
ODD = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "\xa0", "　", "1", "23", ".", ",", "é", "ß", "你", "😀", "▁", "<|endoftext|>", "<s>", "<0x0A>", "'s", "don't", "\0", "​", "\r\n", "ﬁ", "\x85"]
NONE = (0, 0, 0, 0, "", Counter())


@pytest.fixture(scope="module")
def model():
    return alignment.aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def brute(m, text):
    """Counts, digest and links of one text, from the libraries' whole encodings and all pairs of ranges."""
    if not text:
        return NONE
    whole = f" {text}"
    a, b = m.a.encode(whole, add_special_tokens=False).ids, m.b.encode(text)
    if not b"".join(m.a_bytes[i] for i in a) == whole.encode() == b"".join(m.b_bytes[i] for i in b):
        return NONE
    ends_a, ends_b = np.cumsum([len(m.a_bytes[i]) for i in a]).tolist(), np.cumsum([len(m.b_bytes[i]) for i in b]).tolist()
    links = [(a[i], b[j]) for i, (p, q) in enumerate(zip([0, *ends_a], ends_a, strict=False)) for j, (r, s) in enumerate(zip([0, *ends_b], ends_b, strict=False)) if p < s and r < q]
    groups, lo = [], 0
    for e in sorted({*ends_a} & {*ends_b}):
        groups.append(",".join(str(x) for x, q in zip(a, ends_a, strict=True) if lo < q <= e) + "|" + ",".join(str(x) for x, q in zip(b, ends_b, strict=True) if lo < q <= e))
        lo = e
    return len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest(), Counter(links)


def expected(m, texts):
    found = [brute(m, t) for t in texts]
    counts = sum((f[5] for f in found), Counter())
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(*f[:4], sum(n for (a, b), n in f[5].items() if counts[a, b] == most[b]), sum(n * counts[p] for p, n in f[5].items()), f[4]) for f in found], counts


def test_batches_equal_brute_force(model):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 25))) for _ in range(1500)] + [None, "", " ", "   ", "a " * 3000]
    stats, digests, (pair, place, times) = model.batch(texts)
    links = [Counter() for _ in texts]
    for p, i, n in zip(pair.tolist(), place.tolist(), times.tolist(), strict=True):
        assert (p >> 32, p & 0xFFFFFFFF) not in links[i]
        links[i][p >> 32, p & 0xFFFFFFFF] = n
    assert [(*map(int, s), d, c) for s, d, c in zip(stats, digests, links, strict=True)] == [brute(model, t) for t in texts]


def test_bitmaps_keep_all_links():
    rng = np.random.default_rng(5)
    links = {(int(p), int(d)): int(n) for p, d, n in zip(rng.integers(0, 40, 3000), rng.integers(0, 300, 3000), rng.integers(1, 9, 3000), strict=True)}
    pair, doc, times = (np.array(x) for x in zip(*((p, d, n) for (p, d), n in sorted(links.items())), strict=True))
    half = doc < 150
    parts = [alignment.planes(pair[h], doc[h], times[h]) for h in (half, ~half)]
    merged = [alignment.or_merge([p[k] for p in parts if k < len(p)]) for k in range(max(map(len, parts)))]
    pairs, again = np.unique(pair), Counter()
    for k, words in enumerate(merged):
        for p, d in zip(*alignment.unpack(alignment.pack(words, pairs)), strict=True):
            again[int(pairs[p]), int(d)] += alignment.weight(k)
    assert again == Counter(links)


def test_rows_and_pair_counts(spark, model):
    texts = ["the cat sat", "the cat sat", None, "", "the cat  sat\n", "a▁b", "internationalisation", "the cat sat"]
    docs = spark.createDataFrame([(i if i != 3 else None, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, n_a string, pairs int")
    rows, counts = alignment.align(docs, model)
    want, pairs = expected(model, texts)
    got = sorted(rows.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    order = [0, 1, 2, 4, 5, 6, 7, 3]
    assert [tuple(r) for r in got] == [(i if i != 3 else None, *want[i]) for i in order]
    assert {(r.a_id, r.b_id): r.n_links for r in counts.collect()} == pairs


def test_query_on_whole_table(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want, _ = expected(model, [r.text for r in docs])
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in queries.op12_tokenizer_alignment(spark, SF).collect()}
    assert got == {r.doc_id: w for r, w in zip(docs, want, strict=True)}


def test_several_blocks_and_empty(spark, model, monkeypatch):
    texts = [f"word{i % 7} and the {'cat ' * (i % 5)}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(alignment, "BLOCK_DOCS", 16)
    want, _ = expected(model, texts)
    assert {r[0]: tuple(r)[1:] for r in alignment.align(docs, model)[0].collect()} == dict(enumerate(want))
    assert alignment.align(docs.limit(0), model)[0].collect() == []
