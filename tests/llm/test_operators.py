"""The corpus operators against brute force and literal edge cases."""

import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from obsmill.llm import bpe, components, common, html_extract, language_id, lm_score, media, mixing, quality_classifier, quality_rules, queries, resharding, simhash

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, text_hash string, extra int"
EDGE = [(1, None, None, None, None, "x", "y", 1), (2, "", "en", "a", 0, None, None, None), (3, " \t\n", "en", "a", 3, None, None, 1), (None, "one two three four five six seven", "en", None, 1, None, None, 1), (4, "the cat " * 20000, "en", "a", 1, None, None, 1), (4, "the cat " * 20000, "en", "a", 1, None, None, 1), (5, "él año niño 日本", "es", "b", 1, None, None, 1)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


def test_bpe_equals_the_library():
    import public_tokenizers as p
    import tiktoken

    e = queries.tokenizer()
    t = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=e.v.ranks, special_tokens={})
    rng = np.random.default_rng(3)
    for letters in ("aab \n", "'sreLl 1²ⅷ", "абв г", "日本語一", "é̀ü😀\xa0　 \t", "thetherin  "):
        for n in (1, 5, 40, 300):
            text = "".join(rng.choice(list(letters), n))
            ids = e.encode(text)
            assert ids == t.encode_ordinary(text)
            assert e.decode(ids) == text.encode()
    assert e.encode("") == []


def test_simhash_against_brute_force(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = simhash.near_duplicates(df).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in df.select("doc_id").collect())
    fps = {r["doc_id"]: int(r["fingerprint"], 16) for r in rows}
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: find(i) for i in ids}


@pytest.mark.parametrize("dense", [0, 3, 10_000])
def test_dense_halves_lose_no_link(spark, dense):
    rng = np.random.default_rng(1)
    center = int(rng.integers(1 << 62))
    values = {center} | {center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (150, 2))} | {int(x) for x in rng.integers(0, 1 << 62, 30)}
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    with common.Scratch(spark, "test") as scratch:
        nodes = components.connected_components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), scratch, dense), scratch)
        got = {r["node"]: r["root"] for r in nodes.collect()}
    near = [v for v in signed if any(u != v and ((u ^ v) & ((1 << 64) - 1)).bit_count() <= 2 for u in signed)]
    assert set(got) == set(near)
    assert len(set(got.values())) == 1 or dense == 10_000 and len(set(got.values())) >= 1


def test_media_round_trip():
    rng = np.random.default_rng(2)
    payloads = [rng.integers(0, 256, n * media.TILE).astype(np.uint8) for n in (1, 2, 400)] + [media.padded(None)[1], media.padded("é" * 600)[1]]
    files = media.write(payloads)
    for p, (width, height, thumb, mark) in zip(payloads, media.describe(files), strict=True):
        assert thumb.tobytes() == p.tobytes() and width == 192 and height * 3 == len(p) and len(mark) == 16
    with pytest.raises(ValueError):
        media.parse(b"\x89PNG")


def test_mixing_targets(spark):
    rows = [("a", 10), ("b", 1000), ("c", 1000), (None, 50)]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert got["a"] == 30.0 and got[None] == pytest.approx(150.0)
    assert sum(got.values()) == pytest.approx(2060)
    assert got["b"] / got["c"] == pytest.approx(2.0)


def test_fewest_bytes():
    assert resharding.fewest_bytes([5, 1], [3, 3]) == [[3, 2], [0, 1]]
    rng = np.random.default_rng(4)
    for _ in range(20):
        supply = [int(x) for x in rng.integers(0, 50, 5)]
        capacity = [sum(supply) // 4 + (j < sum(supply) % 4) for j in range(4)]
        flow = resharding.fewest_bytes(supply, capacity)
        assert [sum(r) for r in flow] == supply and [sum(c) for c in zip(*flow, strict=True)] == capacity
        assert sum(sum(r) - (r[i] if i < 4 else 0) for i, r in enumerate(flow)) == sum(max(0, s - (capacity[i] if i < 4 else 0)) for i, s in enumerate(supply))


def test_rules_against_brute_force(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    for r in quality_rules.measures(df).collect():
        words = (r["text"] or "").encode().split()
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        seen: dict = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
        covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
        assert (r["n_words"], r["n_repeat_words"]) == (len(words), len(covered))


def test_base_score_against_brute_force(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "A b a"), (2, "b c"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_score.score(df, F.col("doc_id") < 2).collect()}
    norm = np.log10(4 + 0.1 * 4)
    assert got[1]["train_tokens"] == 4 and got[1]["n_tokens"] == 4
    assert got[1]["base_score"] == pytest.approx(2 * np.log10(2.1) + 2 * np.log10(1.1) - 4 * norm)
    assert got[2]["base_score"] == pytest.approx(2 * np.log10(1.1) + np.log10(0.1) - 3 * norm)
    assert got[2]["n_known"] == 2 and got[3]["n_tokens"] == 1


def test_html():
    page = '<body><nav><a>x</a></nav><article><h1>T &amp; t</h1><p>One,\n two.<p><b>Three<br></article><!-- c --><script>"</p>"</script>'
    nodes, blocks = html_extract.read(page)
    assert [t for _, t in blocks] == ["x", "T & t", "One, two.", "Three"]
    labels = html_extract.weak_labels(nodes, blocks)
    odds = np.where(labels > 0, 5.0, -5.0)
    kept = html_extract.decode(nodes, odds)
    assert [t for i, t in blocks if kept[i]] == ["T & t", "One, two.", "Three"]
    assert all(kept[x.parent] for i, x in enumerate(nodes) if i and kept[i])
    assert html_extract.read(None)[1] == []


def test_edges(spark, edge):
    n = edge.count()
    model = language_id.fit(language_id.training_rows(edge))
    names = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(edge, model).collect()}
    assert names[1] == names[2] == names[3] == "und"
    assert simhash.near_duplicates(edge).count() == n
    kept = simhash.drop_near_duplicates(edge)
    assert kept.columns == edge.columns and kept.where("doc_id = 4").count() == 1 and kept.where("doc_id is null").count() == 1
    assert quality_rules.judge(edge).count() == n
    mixed = mixing.copies(edge).collect()
    assert len(mixed) == n and all(r["taken"] <= 3 * r["size"] for r in mixed)
    assert mixing.mix(edge).columns == edge.columns
    e = queries.tokenizer()
    assert bpe.encode(edge, e).where("not round_trip").count() == 0
    assert lm_score.score(edge, common.fold(10) != 0).count() == n
    crc = {r["doc_id"]: r["h"] for r in edge.select("doc_id", common.fold(4).alias("h")).collect()}
    assert crc[5] == zlib.crc32(b"5") % 4


def test_empty(spark, edge):
    none = edge.limit(0)
    assert simhash.drop_near_duplicates(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert quality_rules.judge(none).count() == 0
    assert language_id.identify(none, language_id.fit(none)).count() == 0
    assert lm_score.score(none, common.fold(10) != 0).count() == 0
    marks = spark.createDataFrame([], "doc_id long, label int")
    assert quality_classifier.score(none, quality_classifier.fit(none, marks)).count() == 0
