"""The language model against counts held in dictionaries, and its probabilities' sums."""

import math
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from obsmill.llm import common, lm_score, queries, textnum

DATA = "/root/testdata/sf0.001"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def read(text):
    return [*(text or "").encode().translate(LOWER).split(), b"\n"]


def floor2(n):
    return 1 << (n.bit_length() - 1)


class Plain:
    """The same model from dictionaries, with false positives of ``false``."""

    def __init__(self, texts):
        self.one, self.two = Counter(), Counter()
        for words in texts:
            self.one.update(words)
            self.two.update(zip([b"\n", *words], words))
        self.total = sum(self.one.values()) + 0.1 * (len(self.one) + 1)

    def unigram(self, word):
        return math.log10((self.one[word] + 0.1) / self.total)

    def log(self, before, word, false):
        if not self.one[before]:
            return self.unigram(word)
        s = self.one[before]
        whole = s + s**lm_score.SPREAD + false
        n = self.two[before, word]
        return math.log10(floor2(n) / whole) if n else math.log10(s**lm_score.SPREAD / whole) + self.unigram(word)


@pytest.mark.parametrize(("filter_bytes", "portion_bytes"), [(1 << 24, 1 << 23), (1 << 10, 20_000)])
def test_scores_against_dictionaries(spark, filter_bytes, portion_bytes):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: read(r["text"]) for r in docs.collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    plain = Plain([w for i, w in texts.items() if i not in held])
    got = {r["doc_id"]: r for r in lm_score.score(docs, common.fold(10) != 0, filter_bytes=filter_bytes, portion_bytes=portion_bytes).collect()}
    assert set(got) == set(texts)
    for i, words in texts.items():
        most, least = (sum(plain.log(a, b, false) for a, b in zip([b"\n", *words], words)) for false in (0.0, 0.3))
        assert least - 0.02 * len(words) - 2 <= got[i]["score"] <= most + 0.02 * len(words) + 2  # false positives, both ways
        assert got[i]["base_score"] == pytest.approx(sum(map(plain.unigram, words)))
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (len(words), sum(w in plain.one for w in words))
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)


def test_probabilities_of_next_words_sum_to_one_or_less():
    """After each of some contexts, over all words: those held falsely are within E on average."""
    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(1, 1 << 62, 3_000).astype(np.uint64))
    words[0] = lm_score.END_HASH
    tokens = (3_000 * rng.random(60_000) ** 3).astype(np.int64).clip(0, len(words) - 1)
    count = np.bincount(tokens, minlength=len(words))
    before, keys = lm_score.pairs_of(words, tokens, np.array([len(tokens)]))
    pairs, n = np.unique(textnum.mix(keys), return_counts=True)
    held = lm_score.LogFrequencyFilter(pairs, n, 10)
    assert 0.3 < held.fill < 0.55 and (held.chain(pairs) >= np.frexp(n)[1]).all()
    false, norm = len(words) * held.false_share(), np.log10(count.sum() + 0.1 * (len(words) + 1))
    sums = []
    for context in rng.choice(np.unique(before), 60, replace=False):
        two = np.stack([np.full(len(words), context), np.arange(len(words))], 1).ravel()
        at, key = lm_score.pairs_of(words, two, np.full(len(words), 2))
        model = lm_score.logs(count, two, at, held.chain(textnum.mix(key)), norm, false, lm_score.SPREAD)[1]
        sums.append((10 ** model[1::2]).sum())
    assert np.mean(sums) <= 1 and max(sums) < 1.5


def test_tokens_and_pairs():
    tokens, owner = lm_score.tokens_of([b"A b", b"", b" \tb a\n"])
    assert owner.tolist() == [0, 0, 0, 1, 2, 2, 2]
    assert tokens[0] == tokens[5] and tokens[1] == tokens[4] and tokens[2] == tokens[3] == tokens[6] == lm_score.END_HASH
    words, of = np.unique(tokens, return_inverse=True)
    before, keys = lm_score.pairs_of(words, of, np.array([3, 1, 3]))
    assert before.tolist() == [0, of[0], of[1], 0, 0, of[4], of[5]]
    assert len(set(keys.tolist())) == 7 and textnum.encode(None) == b""


def test_keys_are_dealt_whole():
    keys = np.sort(np.random.default_rng(2).integers(0, 1 << 63, 5_000).astype(np.uint64) * np.uint64(2))
    for slices in (1, 64, 100_003):
        at = lm_score.cuts(keys, slices)
        assert at[0] == 0 and at[-1] == len(keys) and (np.diff(at) >= 0).all()
    for x in (keys, keys[:0], keys[:1]):
        assert (lm_score.unpacked_keys(lm_score.packed_keys(x)) == x).all()
    for kind in (np.uint8, np.int32, np.int64):
        x = (keys % np.uint64(97)).astype(kind)
        assert (lm_score.unpacked(lm_score.packed(x), kind) == x).all() and lm_score.unpacked(lm_score.packed(x[:0]), kind).size == 0


def test_contract(spark):
    rows = queries.op10_lm_score(spark, DATA)
    assert rows.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double")]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    rows = lm_score.score(docs, F.lit(False)).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows] == [(0, 0, 0.0, 0.0)] * 2


def test_ids_of_text_and_rows_that_repeat(spark):
    docs = spark.createDataFrame([("a", "x y x"), ("a", "x y x"), (None, "x y x"), ("b", ""), ("c", None)], "doc_id string, text string")
    rows = lm_score.score(docs, F.col("doc_id") == "a").collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"]) for r in rows) == [("None", 4, 4), ("a", 4, 4), ("a", 4, 4), ("b", 1, 1), ("c", 1, 1)]
    assert len({round(r["score"], 9) for r in rows if r["n_tokens"] == 4}) == 1 and rows[0]["train_tokens"] == 8
