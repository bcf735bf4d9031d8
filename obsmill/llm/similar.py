"""Near-duplicate components by the Jaccard similarity of word shingles: SimHash with multi-index hashing, then an exact way for the rest.

Two texts link where the similarity of their sets of 64-bit shingle hashes is ``share`` or more. Candidates come
from SimHash fingerprints of the sets, of 192 bits, by multi-index hashing (``simhash.near_segments``): fingerprints
meet where a segment of 32 bits differs in two bits or fewer, which is sure up to 17 bits in all. Pairs at ``DISTANCE``
bits or fewer are verified on the whole sets, and what has come into one component needs no more comparing: first, all
of an equal segment are compared with one of them, so most of a group of copies links by a few pairs each; then those
that meet in a near one with ``ROUNDS`` of them, where links so far leave them in different components. Either is
linear in groups of copies of any size: a fingerprint has 6 equal segments and 198 near ones.

A pair at share 0.8 lies about 29 of 192 bits apart, and no distance is sure: fingerprints alone lose links. So
the pairs they leave are found exactly, between components only, from prefixes: under any order of all shingles, two
sets of the similarity have a shingle in common among the first n - ceil(share * n) + 1 of each. So a shared prefix
shingle is looked for, and every candidate is verified. The order puts shingles that a sample of texts finds frequent
last, which keeps common passages out of the prefixes; the result doesn't depend on the sample, as the argument holds
for any order, nor on the fingerprints, as each of their links is verified.

Each set also has a bitmap of the parities of its shingles' buckets. A shingle that is in one of two sets changes
one bit, so bitmaps differ in no more bits than the sets in shingles, and candidates whose bitmaps or sizes differ
by more than the similarity allows are passed over without looking at the sets; no pair is lost. Neither is one by
passing over shared shingles that lie too far back in a set to be the first of enough shared ones. Small bitmaps go
with the prefixes; what they leave is looked at by larger ones, which tell longer texts apart.

Defined results: null text and text without words have the one shingle 0 and link with one another. Fewer words
than a shingle: the whole sequence is the one shingle. Texts of equal sets are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmill.llm import common, components, simhash, textnum

WORDS, MORE_WORDS = 4, 64  # of 64 bits in the small and the large bitmap
STEP = np.uint64(0xD6E8FEB86659FD93)
FP_WORDS, DISTANCE = 3, 60  # of 64 bits in a fingerprint; fingerprints of unlike texts differ in 96 bits, give or take 7
ROUNDS = 2  # with how many of those that meet in a value a fingerprint is compared


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; words are of bytes, A-Z and ASCII white space alone."""
    raw = [textnum.encode(t) for t in texts]
    for lo, hi in textnum.blocks(raw):
        buf, starts = textnum.joined(raw[lo:hi], lower=True)
        begin, end = textnum.words(buf)
        h = textnum.word_hashes(buf, begin, end) if len(begin) else np.zeros(0, np.uint64)
        wide = np.zeros(max(0, len(h) - width + 1), np.uint64)
        for k in range(width):
            wide = wide * STEP + h[k : k + len(wide)]
        wide = textnum.mix(wide)
        cut = np.searchsorted(begin, np.append(starts, len(buf)))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if a == b:
                yield np.zeros(1, np.uint64)
            elif b - a < width:
                short = np.uint64(b - a)
                for x in h[a:b]:
                    short = textnum.mix(np.array([short]) * STEP + x)[0]
                yield np.array([short], np.uint64)
            else:
                yield np.unique(wide[a : b - width + 1])


def prefix(shingles: np.ndarray, frequent: np.ndarray, parts: tuple[int, int]) -> np.ndarray:
    """The first of a set's shingles in the order (frequent, hash): two sets of the similarity share one of them."""
    a, b = parts
    n = len(shingles)
    take = n - -(-a * n // b) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        often = frequent[at] == shingles
        shingles = np.concatenate([shingles[~often], shingles[often]])
    return shingles[:take]


def bitmap(shingles: np.ndarray, words: int) -> np.ndarray:
    """For each of 64 * words buckets whether an odd number of the shingles falls into it."""
    odd = np.bincount((shingles & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _of_sets(text: Column, width: int, frequent: Broadcast | None = None, parts: tuple[int, int] = (4, 5)) -> Column:
    """node, size, fp, bitmap and the prefix (without ``frequent``, no fp and the whole set) of a text's shingles."""

    @F.pandas_udf("node long, size int, fp array<long>, bitmap array<long>, shingles array<long>")
    def column(texts: pd.Series) -> pd.DataFrame:
        out: dict[str, list] = {"node": [], "size": [], "fp": [], "bitmap": [], "shingles": []}
        for x in shingle_sets(texts.tolist(), width):
            out["node"].append(np.uint64(xxhash.xxh64_intdigest(x.tobytes())).astype(np.int64))
            out["size"].append(len(x))
            out["fp"].append(None if frequent is None else simhash.wide(x, FP_WORDS).view(np.int64))
            out["bitmap"].append(bitmap(x, MORE_WORDS if frequent is None else WORDS))
            out["shingles"].append((x if frequent is None else prefix(x, frequent.value, parts)).view(np.int64))
        return pd.DataFrame(out)

    return column(text)


def frequent_shingles(docs: DataFrame, text: str, width: int, sample: int = 5_000, every: int = 16, least: int = 3, most: int = 1 << 20) -> np.ndarray:
    """Sorted shingles in ``least`` or more different texts of a sample, the ``most`` most frequent of them.

    The sample is of about ``sample`` texts, or one in ``every`` where that is more, so that the number of texts
    from which on a shingle is found frequent doesn't grow with the corpus.
    """
    n = docs.count()
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(23), text), 1) <= common.hash_below(max(sample, n // every), n)
    some = docs.where(draw).select(text).distinct().select(_of_sets(F.col(text), width).alias("x")).select(F.explode("x.shingles").alias("key"))
    top = some.groupBy("key").count().where(F.col("count") >= least).orderBy(F.desc("count"), "key").limit(most).select("key").toPandas()
    return np.sort(top["key"].to_numpy(np.int64).view(np.uint64))


def possible(u: str, v: str, parts: tuple[int, int]) -> Column:
    """Whether sizes and bitmaps of the sets u and v allow the similarity: it allows (b - a) / (b + a) of both sizes to differ."""
    a, b = parts
    less, more = F.least(f"{u}.size", f"{v}.size"), F.greatest(f"{u}.size", f"{v}.size")
    bits = F.aggregate(F.zip_with(f"{u}.bitmap", f"{v}.bitmap", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return (b * less >= a * more) & ((a + b) * bits <= (b - a) * (less + more))


def placed(u: str, v: str, parts: tuple[int, int]) -> Column:
    """Whether a shingle at its place in u and in v can be the first that they share: with those after it, it must reach the overlap.

    A pair that has the similarity meets this at its first shared shingle, which is in both prefixes.
    """
    a, b = parts
    rest = F.least(F.col(f"{u}.size") - F.col(f"{u}.pos"), F.col(f"{v}.size") - F.col(f"{v}.pos"))
    return (a + b) * rest >= a * (F.col(f"{u}.size") + F.col(f"{v}.size"))


def verified(pairs: DataFrame, sets: DataFrame, parts: tuple[int, int], scratch: common.Scratch, name: str) -> DataFrame:
    """The pairs (u, v) whose sets have the similarity parts[0] / parts[1] or more."""
    a, b = parts
    of = sets.select("node", F.struct("size", "bitmap").alias("of"))
    pairs = pairs.join(of.toDF("u", "a"), "u").join(of.toDF("v", "b"), "v").where(possible("a", "b", parts)).select("u", "v")
    pairs = scratch.table(pairs, f"{name}-left")
    sets = sets.join(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "node", "left_semi")
    left, right = sets.select(F.col("node").alias("u"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("v"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "u").join(right, "v").where((a + b) * both >= a * (F.size("x") + F.size("y"))).select("u", "v").distinct()


def fingerprint_pairs(prefixes: DataFrame, nodes: DataFrame | None, keys: Column, rounds: int, parts: tuple[int, int], scratch: common.Scratch) -> DataFrame:
    """(u, v): of fingerprints that meet in one of ``keys``, each with ``rounds`` of them, where roots differ and fingerprints and bitmaps are near."""
    linked = prefixes.select("node", "fp", F.lit(None).cast("long").alias("root")) if nodes is None else prefixes.select("node", "fp").join(nodes, "node", "left")
    spread = linked.select("node", "root", F.explode(keys).alias("key")).repartition("key")  # one shuffle for both uses, as either reads both columns
    root = F.coalesce("root", "node")
    several = spread.groupBy("key").agg(F.min(root).alias("a"), F.max(root).alias("b")).where("a <> b").select("key")
    met = scratch.table(spread.join(several, "key").select("key", "node", root.alias("root")), "met")
    ones = met.groupBy("key").agg(F.array_distinct(F.array(*[F.min_by(F.struct("node", "root"), F.xxhash64(F.lit(k), "node")) for k in range(rounds)])).alias("ones"))
    others = F.filter("ones", lambda one: one["root"] != F.col("root"))  # before they become rows
    pairs = met.join(ones, "key").select("node", F.explode(others).alias("one")).select(F.least("node", "one.node").alias("u"), F.greatest("node", "one.node").alias("v")).distinct()
    of = prefixes.select("node", F.struct("fp", "of.size", "of.bitmap").alias("of"))
    near = (simhash.distance("a.fp", "b.fp") <= DISTANCE) & possible("a", "b", parts)
    return pairs.join(of.toDF("u", "a"), "u").join(of.toDF("v", "b"), "v").where(near).select("u", "v")


def prefix_pairs(prefixes: DataFrame, nodes: DataFrame | None, parts: tuple[int, int], scratch: common.Scratch) -> DataFrame:
    """(u, v): all nodes of different roots that share a prefix shingle and may have the similarity; a node without a root is its own."""
    rooted = prefixes.withColumn("root", F.col("node")) if nodes is None else prefixes.join(nodes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    spread = rooted.select("node", "root", F.posexplode("shingles").alias("pos", "key")).repartition("key")  # one shuffle for both uses
    several = spread.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    shared = scratch.table(spread.join(several, "key"), "shared")
    buckets = scratch.table(shared.join(prefixes.select("node", "of"), "node").select("key", "root", F.struct("node", "of.size", "of.bitmap", "pos").alias("of")), "buckets")
    scratch.drop("shared")
    pairs = buckets.join(buckets.select("key", F.col("of").alias("other"), F.col("root").alias("_root")), "key").where("of.node < other.node and root <> _root")
    return pairs.where(placed("of", "other", parts) & possible("of", "other", parts)).select(F.col("of.node").alias("u"), F.col("other.node").alias("v")).distinct()


def roots(docs: DataFrame, scratch: common.Scratch, text: str, width: int, parts: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, node) for each row of docs, and (node, root) of nodes that link with another."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, text, width))
    text_hash = F.xxhash64(text).alias("text_hash")
    held = scratch.table(docs.select("doc_id", text_hash, _of_sets(F.col(text), width, frequent, parts).alias("x")).select("doc_id", "text_hash", "x.*"), "held")
    rows = scratch.table(held.select("doc_id", "text_hash", "node"), "rows")
    prefixes = scratch.table(held.groupBy("node").agg(F.first(F.struct("size", "bitmap")).alias("of"), F.first("fp").alias("fp"), F.first("shingles").alias("shingles")), "prefixes")
    scratch.drop("held")
    nodes = None
    for name, keys, rounds in [("equal", simhash.segments("fp"), 1), ("near", simhash.near_segments("fp"), ROUNDS), ("rest", None, 0)] if ROUNDS else [("rest", None, 0)]:
        with common.Scratch(spark, f"similar-{name}") as inner:
            pairs = fingerprint_pairs(prefixes, nodes, keys, rounds, parts, inner) if rounds else prefix_pairs(prefixes.drop("fp"), nodes, parts, inner)
            pairs = inner.table(pairs, "pairs")
            if pairs.isEmpty():
                continue
            # One row of each set in a pair; rows that are equal in id and text can come along, which repeats links only.
            asked = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
            one_row = rows.join(asked, "node", "left_semi").groupBy("node").agg(F.min(F.struct("text_hash", "doc_id")).alias("x")).select("x.*")
            same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.text_hash") == F.col("r.text_hash"))
            found = docs.select("doc_id", text, text_hash).alias("d").join(one_row.alias("r"), same, "left_semi").select(_of_sets(F.col(text), width).alias("x"))
            sets = inner.table(found.select("x.node", "x.size", "x.bitmap", "x.shingles"), "sets")
            new = scratch.table(verified(pairs, sets, parts, inner, "pairs"), f"links-{name}")
            if new.isEmpty():
                continue
            # Of the links before, one a node is enough: that with its root.
            edges = new if nodes is None else new.unionAll(nodes.select(F.col("node").alias("u"), F.col("root").alias("v")))
            nodes = scratch.table(components.connected_components(edges, inner), f"nodes-{name}")
    frequent.destroy()
    return rows, nodes if nodes is not None else spark.createDataFrame([], "node long, root long")


def drop_near_duplicates(docs: DataFrame, text: str = "text", width: int = 5, parts: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row of each component stays: that of the smallest doc_id (then of the smallest text hash)."""
    mark = common.fresh(docs, "text_hash")
    with common.Scratch(docs.sparkSession, "similar") as scratch:
        rows, nodes = roots(docs.select("doc_id", text), scratch, text, width, parts)
        order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
        first = rows.join(nodes, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(order).alias("first"))
        first = common.Scratch(docs.sparkSession, "similar-kept").result(first.select("first.doc_id", "first.text_hash"))
        repeated = not rows.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col(f"d.{mark}") == F.col("f.text_hash"))
    kept = docs.withColumn(mark, F.xxhash64(text)).alias("d").join(first.alias("f"), same, "left_semi")
    return (kept.dropDuplicates(["doc_id", mark]) if repeated else kept).drop(mark)
