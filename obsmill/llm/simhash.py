"""Near-duplicate components by SimHash with multi-index hashing.

Fingerprints of 64 bits link at two differing bits or fewer. Each is split into two halves. Two linked
fingerprints agree in the low half, or differ by at most one bit in the high half (if the high half took both
differences, the low half has none). So the low halves are looked up as they are and the high halves with
their Hamming ball of radius one: 34 probes of a table, whose matches are verified over all 64 bits.

A half that many fingerprints share would make the matches grow with the square of their number. Fingerprints
that share a half with more than ``dense`` others, and those whose probes hit such a half, take an exact way
instead: each is linked to the 64 values one bit away from it. Two values at distance two or less have one
such value in common (or are one another's), and a value has at most 65 of them, so nothing grows but linearly.

Wider fingerprints, of whole numbers of 64 bits, serve other operators (``wide``, ``near_segments``, ``distance``).
They are cut into segments of 32 bits, and each segment is looked up with its ball of radius one from both sides:
two segments at two bits or fewer meet in a value that is at most one bit from each. Fingerprints of m segments
that differ in 3 m - 1 bits or fewer have such a segment, so they meet; most that differ in some more do as well.

Defined results: null text and text without words have fingerprint zero and link like any other. Fewer words
than a shingle: the whole sequence is the one shingle. Equal fingerprints are one node, however many documents
hold them. A null doc_id never is the smallest; a component of null ids alone has a null component_id.
Repeated rows appear as often as they came; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmill.llm import common, components, textnum

SEED = 42
HALF = 32


def fingerprints(texts: list[str | None], width: int) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = textnum.encode(text).lower().split()  # of bytes: A-Z and ASCII white space alone
        if not words:
            continue
        if len(words) <= width:
            hashes = [digest(b" ".join(words), SEED)]
        else:
            hashes = [digest(b" ".join(x), SEED) for x in zip(*(words[k:] for k in range(width)), strict=False)]
        out[i] = _majority(np.array(hashes, np.uint64))
    return out


def _majority(hashes: np.ndarray) -> np.uint64:
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo : lo + (1 << 16)]
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).view(">u8")[0]


def wide(hashes: np.ndarray, words: int) -> np.ndarray:
    """A fingerprint of 64 * words bits; further bits than the hashes' own are of the hashes mixed again."""
    out = np.zeros(words, np.uint64)
    for k in range(words):
        out[k] = _majority(hashes)
        hashes = textnum.mix(hashes + np.uint64(0x9E3779B97F4A7C15))
    return out


def segments(fp: str) -> Column:
    """Of a wide fingerprint, an array of longs: its segments, each under its number."""
    low = F.lit((1 << HALF) - 1)
    return F.flatten(F.transform(fp, lambda x, i: F.array(F.shiftleft((2 * i).cast("long"), HALF).bitwiseOR(F.shiftrightunsigned(x, HALF)), F.shiftleft((2 * i + 1).cast("long"), HALF).bitwiseOR(x.bitwiseAND(low)))))


def near_segments(fp: str) -> Column:
    """Of a wide fingerprint, an array of longs: all values at one bit or none from a segment, under the segment's number."""
    ball = F.array(*[F.lit(x).cast("long") for x in (0, *(1 << i for i in range(HALF)))])
    return F.flatten(F.transform(segments(fp), lambda s: F.transform(ball, lambda b: s.bitwiseXOR(b))))


def distance(u: str, v: str) -> Column:
    """The number of bits in which two wide fingerprints differ."""
    return F.aggregate(F.zip_with(u, v, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def fingerprint(text: Column, width: int = 3) -> Column:
    """The fingerprint of a text as a long with the same bits."""

    @F.pandas_udf("long")
    def column(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(texts.tolist(), width).view(np.int64))

    return column(text)


def _half(fp: str, which: int) -> Column:
    return F.shiftrightunsigned(F.col(fp), HALF) if which == 0 else F.col(fp).bitwiseAND(F.lit((1 << HALF) - 1))


def links(fps: DataFrame, scratch: common.Scratch, dense: int = 200) -> DataFrame:
    """(u, v): edges whose components are those of the distinct fingerprints in column fp."""
    ball = [0, *(1 << i for i in range(HALF))]
    halves = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("part"), _half("fp", k).alias("key")) for k in (0, 1)])).alias("h")).select("fp", "h.*")
    crowded = scratch.table(halves.groupBy("part", "key").count().where(F.col("count") > dense).select("part", "key"), "crowded")
    probes = [F.struct(F.lit(0).alias("part"), _half("fp", 0).bitwiseXOR(F.lit(x)).alias("key")) for x in ball] + [F.struct(F.lit(1).alias("part"), _half("fp", 1).alias("key"))]
    probe = fps.select(F.col("fp").alias("u"), F.explode(F.array(*probes)).alias("h")).select("u", "h.*")
    if crowded.isEmpty():
        found, stars = probe.join(halves, ["part", "key"]), None
    else:
        found = probe.join(halves.join(crowded, ["part", "key"], "left_anti"), ["part", "key"])
        near = halves.join(crowded, ["part", "key"], "left_semi").select("fp").unionAll(probe.join(crowded, ["part", "key"], "left_semi").select(F.col("u").alias("fp"))).distinct()
        flips = F.array(*[F.lit(-(1 << 63) if i == 63 else 1 << i) for i in range(64)])
        near = scratch.table(near, "near")
        # A middle value counts only if two fingerprints or more are one bit from it, or it is one itself.
        middles = near.select("fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("middle")).unionAll(near.select("fp", F.col("fp").alias("middle")))
        least = middles.groupBy("middle").agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1").select("middle", "u")
        stars = middles.join(least, "middle").select("u", F.col("fp").alias("v")).where("u <> v")
    pairs = found.where((F.col("u") < F.col("fp")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("fp"))) <= 2)).select("u", F.col("fp").alias("v"))
    return pairs if stars is None else pairs.unionAll(stars)


def near_duplicates(docs: DataFrame, text: str = "text", width: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of docs: doc_id, the columns of ``carry``, fp, fingerprint (hexadecimal), component_id."""
    with common.Scratch(docs.sparkSession, "simhash") as scratch:
        held = common.Scratch(docs.sparkSession, "simhash-rows").result(docs.select("doc_id", *carry, fingerprint(F.col(text), width).alias("fp")))
        fps = scratch.table(held.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
        nodes = components.connected_components(links(fps.select("fp"), scratch), scratch)
        roots = fps.join(nodes, fps["fp"] == nodes["node"]).groupBy("root").agg(F.min("least").alias("component_id"))
        linked = nodes.join(roots, "root").select(F.col("node").alias("fp"), "component_id", F.lit(True).alias("linked"))
        of = common.Scratch(docs.sparkSession, "simhash-components").result(fps.join(linked, "fp", "left").select("fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id")))
    return held.join(of, "fp").select("doc_id", *carry, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of each component of near-duplicates stays: that of the smallest doc_id (then of the smallest text hash)."""
    mark = common.fresh(docs, "text_hash")
    rows = near_duplicates(docs.select("doc_id", text, F.xxhash64(text).alias(mark)), text, carry=(mark,))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", mark)
    first = rows.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp")).agg(F.min(order).alias("first")).select("first.*").distinct()
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col(f"d.{mark}") == F.col(f"f.{mark}"))
    kept = docs.withColumn(mark, F.xxhash64(text)).alias("d").join(first.alias("f"), same, "left_semi")
    return kept.dropDuplicates(["doc_id", mark]).drop(mark)
