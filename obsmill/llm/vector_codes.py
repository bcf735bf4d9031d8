"""Compression of vectors to codes of their parts by Ball k-means.

Components become integers, a vector is cut into equal parts, and each part position has a codebook of entries.
A round assigns every part to its nearest entry and moves entries to the floor of their parts' means. All sums
and distances are integers, so results are exact and don't depend on how rows are dealt out.

Each block of vectors keeps the parts' last entries. In a block, an entry and its parts are a ball about the
entry, whose radius is the farthest part's distance. Only entries nearer to it than twice the radius can be
nearer to one of its parts: they are its neighbours. A part nearer to its entry than half the way to the nearest
neighbour is in the stable core and is skipped. A part beyond lies in an annular ring: between half the ways to
two successive neighbours, and only those up to the ring are measured. Bounds hold at equality too, so that a tie
goes to the lower index.

Blocks are written anew each round with their parts' sums; what reaches the driver is one row an entry and part.

Defined results: rows whose vector is null, empty, or holds a null or non-finite component are left out, and those
whose length differs from that of the smallest kept vec_id's (as their parts would not be of the codebook's size).
Null vec_ids come last in the order of first entries, repeated ones by their vector; repeated rows each count.
Fewer rows than entries: as many entries as rows. Components whose squares would leave 64 bits (beyond about
2**27 / sqrt(length) after scaling) raise an error, as does a length that the number of parts doesn't divide.
Null labels are one label. An empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmill.llm import common

BLOCK = 8192


def finite(vector: str | Column) -> Column:
    """Whether a vector is there, isn't empty, and all its components are finite numbers."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(False))


def scaled(vectors: list, factor: int) -> np.ndarray:
    out = np.floor(np.stack([np.asarray(v, np.float64) for v in vectors]) * factor)
    if np.abs(out).max() * np.sqrt(out.shape[1]) >= 2**30:
        raise ArithmeticError("components are too large for exact distances in 64 bits")
    return out.astype(np.int64)


def nearest(x: np.ndarray, before: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each part's nearest entry (ties to the lower index) and squared distance, from any assignment before."""
    own = ((x - book[before]) ** 2).sum(axis=1)
    ways = ((book[:, None, :] - book[None]) ** 2).sum(axis=2)
    best, least = before.copy(), own.copy()
    radius = np.full(len(book), -1, np.int64)
    np.maximum.at(radius, before, own)
    for k in np.flatnonzero(radius >= 0):
        near = np.flatnonzero(ways[k] <= 4 * radius[k])
        near = near[near != k]
        if not len(near):
            continue
        near = near[np.argsort(ways[k][near], kind="stable")]
        rows = np.flatnonzero((before == k) & (4 * own >= ways[k][near[0]]))
        ring = np.searchsorted(ways[k][near], 4 * own[rows], "right")
        for j, entry in enumerate(near):
            rows, ring = rows[ring > j], ring[ring > j]
            if not len(rows):
                break
            d = ((x[rows] - book[entry]) ** 2).sum(axis=1)
            nearer = (d < least[rows]) | ((d == least[rows]) & (entry < best[rows]))
            best[rows[nearer]], least[rows[nearer]] = entry, d[nearer]
    return best, least


def assign(x: np.ndarray, before: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries and squared distances of all parts: x is vectors by parts by places, books parts by entries by places."""
    found = [nearest(x[:, p], before[:, p], books[p]) for p in range(len(books))]
    return np.stack([b for b, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def sums(x: np.ndarray, codes: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    total, count = np.zeros((x.shape[1], entries, x.shape[2]), np.int64), np.zeros((x.shape[1], entries), np.int64)
    for p in range(x.shape[1]):
        np.add.at(total[p], codes[:, p], x[:, p])
        count[p] = np.bincount(codes[:, p], minlength=entries)
    return total, count


def moved(books: np.ndarray, total: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Entries at the floor of their parts' means; unused ones stay."""
    return np.where(count[..., None] > 0, total // np.maximum(count, 1)[..., None], books)


def _round(books: np.ndarray, size: int):
    """A step over blocks: parts to their nearest entries, with the parts' sums."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, entries, places = books.shape
        for frame in batches:
            rows = []
            for ids, labels, raw, codes in zip(frame["id"], frame["label"], frame["x"], frame["a"], strict=True):
                x = np.frombuffer(raw, "<i4").astype(np.int64).reshape(-1, parts, places)
                found, d = assign(x, np.frombuffer(codes, np.uint8).astype(np.int64).reshape(-1, parts), books)
                total, count = sums(x, found, entries)
                rows.append((ids, labels, raw, found.astype(np.uint8).tobytes(), total.ravel(), count.ravel(), d.sum(axis=1)))
            yield pd.DataFrame(rows, columns=["id", "label", "x", "a", "sums", "counts", "error"])

    return step


def _blocks(factor: int, parts: int, length: int):
    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for lo in range(0, len(frame), BLOCK):
                part = frame.iloc[lo : lo + BLOCK]
                x = scaled(part["v"].tolist(), factor)
                none = np.zeros(len(part) * parts, np.uint8).tobytes()
                plain = [[None if pd.isna(v) else v for v in part[c].tolist()] for c in ("id", "label")]
                yield pd.DataFrame([(*plain, x.astype("<i4").tobytes(), none)], columns=["id", "label", "x", "a"])

    return step


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, factor: int = 4096) -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes as bytes, error) of each kept vector, read from a written table; and the codebooks (parts, entries, places)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v")).where(finite("v"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "label")]
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return spark.createDataFrame([], f"id {kinds[0]}, label {kinds[1]}, code binary, error long"), np.zeros((parts, 0, 0), np.int64)
    length = len(first[0]["v"])
    if length % parts:
        raise ValueError(f"{parts} parts do not divide vectors of {length} components")
    same = rows.where(F.size("v") == length)
    first = [r["v"] for r in (first if all(len(r["v"]) == length for r in first) else same.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect())]
    books = scaled(first, factor).reshape(len(first), parts, -1).transpose(1, 0, 2)
    shape = f"id array<{kinds[0]}>, label array<{kinds[1]}>, x binary, a binary"
    state = same.mapInPandas(_blocks(factor, parts, length), shape)
    with common.Scratch(spark, "vector-codes") as scratch:
        for k in range(rounds):
            before, state = f"round{k - 1}", scratch.table(state.mapInPandas(_round(books, length), f"{shape}, sums array<long>, counts array<long>, error array<long>"), f"round{k}")
            totals = [r[0] for r in state.select(F.posexplode(F.concat("sums", "counts")).alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).orderBy("at").select("n").collect()]
            cut = books.size
            books = moved(books, np.array(totals[:cut], np.int64).reshape(books.shape), np.array(totals[cut:], np.int64).reshape(books.shape[:2]))
            state = state.select("id", "label", "x", "a")
            if k:
                scratch.drop(before)
        last = state.mapInPandas(_round(books, length), f"{shape}, sums array<long>, counts array<long>, error array<long>")
        cut_up = F.transform(F.sequence(F.lit(0), F.size("id") - 1), lambda i: F.substring("a", i * parts + 1, F.lit(parts)))
        flat = last.select("id", "label", "error", cut_up.alias("code")).select(F.inline(F.arrays_zip("id", "label", "code", "error")))
        return common.Scratch(spark, "vector-codes-rows").result(flat), books


def label_errors(coded: DataFrame) -> DataFrame:
    """The rows with label_error, the errors' sum over the same label (nulls together).

    Labels of a thousandth of all rows or more are a thousand at the most, so their sums are broadcast; the
    others' rows are joined by label.
    """
    sums_ = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    sums_ = common.Scratch(coded.sparkSession, "label-errors").result(sums_)
    everything = sums_.agg(F.sum("n")).first()[0] or 0
    often, seldom = (sums_.where(c).select(F.col("label").alias("of"), "label_error") for c in (F.col("n") * 1000 >= everything, F.col("n") * 1000 < everything))
    same = F.col("label").eqNullSafe(F.col("of"))
    hot = coded.join(F.broadcast(often), same)
    return hot.unionByName(coded.join(F.broadcast(often), same, "left_anti").join(seldom, same)).drop("of")


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
