"""Alignment of two tokenizers over a corpus by inverted pair bitmaps.

Both tokenizers cut the same bytes. Where they end a token at the same byte, a group ends; a token of one and
a token of the other link where their byte ranges overlap. Texts are cut before spaces that follow other
characters: neither tokenizer's tokens cross such a place, so a chunk is aligned once and remembered.

Documents are taken in blocks. A block holds, for each pair of linked ids, a bitmap of its documents, and for
repeats one bitmap a binary digit of (times - 1): the multiplicity planes. The bitmaps of a block's batches are
merged by OR. Their words of 64 documents are stored by their one document (2 bytes) or as they are. A block's
document count of a pair is a popcount, its link count the popcounts weighted by the planes' digits; both are
summed over the blocks. The corpus-wide counts come back to the block's postings, which hand them to the
documents. What is shuffled by pair is a pair's counts, never its bitmaps.

Defined results: null, empty, and texts whose tokens' bytes don't give the text again have no tokens, zeros and
an empty digest. Repeated rows and ids each are rows and each count. Null ids stay null. Ties: every pair of the
B id's highest count is best. Texts of any length are one document of a block, however long. An empty table
gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmill.llm import common, textnum
from obsmill.llm.bpe import BESIDE, WHITE_SPACE

META = "▁"
CUT = re.compile(f"(?<=[^{WHITE_SPACE}])(?= )")
BLOCK_DOCS, BLOCK_CHARS = 2048, 4 << 20
TOGETHER = 512
#: Fixed value: how byte-level vocabularies cut texts before merging.
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SETTLED = re.compile("[\\x00-\u024f]*")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def split(text: str) -> list[str]:
    """Chunks of a text that begins with a space; each begins with one."""
    if "\0" in text or BESIDE.search(text):
        return CUT.split(text)
    return text.replace(" ", "\0 ").split("\0")[1:]


def _digits(ids: np.ndarray, width: int) -> np.ndarray:
    """The ids' decimal digits as bytes, zero bytes before them and a free byte after them."""
    out = np.zeros((len(ids), width + 1), np.uint8)
    rest = ids.copy()
    for k in range(width - 1, -1, -1):
        out[:, k] = np.where((rest > 0) | (k == width - 1), 48 + rest % 10, 0)
        rest //= 10
    return out


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the sum of each one's times."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(times[order], first)


def _counts(sorted_values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the values lie in (bound before, bound]."""
    return np.diff(np.searchsorted(sorted_values, bounds, "right"), prepend=0)


class Aligner:
    """Both tokenizers, and what was found for up to ``kept`` chunks a worker."""

    def __init__(self, a_json: str, b_proto: bytes, kept: int = 400_000):
        self.a_json, self.b_proto, self.kept = a_json, b_proto, kept
        self._clear()

    def __getstate__(self) -> dict:
        return {"a_json": self.a_json, "b_proto": self.b_proto, "kept": self.kept}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.said: list[bytes] = []
        self.stats = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links; all -1 if bytes differ
        self.links, self.link_to, self.new = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    @cached_property
    def a(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        out = Tokenizer.from_str(self.a_json)
        out.encode_special_tokens = True
        return out

    @cached_property
    def quick(self):
        """A faster library's encoder of the same vocabulary, None where merges aren't in the order of their ids or texts are changed or cut otherwise.

        It serves texts of ``SETTLED`` characters alone, which all versions of Unicode class alike.
        """
        import tiktoken

        said, letters = json.loads(self.a_json), byte_letters()
        model, before = said["model"], said.get("pre_tokenizer") or {}
        parts = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        made = [model["vocab"].get("".join(m), -1) for m in parts]
        plain = model.get("type") == "BPE" and said.get("normalizer") is None and not model.get("dropout") and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        if not plain or not made or made != sorted(set(made)) or made[0] < 0 or not all(c in model["vocab"] for c in letters):
            return None
        kept = {"".join(m) for m in parts} | {*letters}
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t in kept}
        return tiktoken.Encoding("a", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def _encode_a(self, chunks: list[str]) -> list[list[int]]:
        if self.quick and all(map(SETTLED.fullmatch, chunks)):
            return [self.quick.encode_ordinary(c) for c in chunks]
        return [e.ids for e in self.a.encode_batch(chunks, add_special_tokens=False)]

    @cached_property
    def b(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.b_proto)

    @cached_property
    def a_bytes(self) -> list[bytes]:
        letters, of = byte_letters(), self.a.get_vocab(with_added_tokens=True)
        out = [b""] * (max(of.values()) + 1)
        for token, i in of.items():
            out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        return out

    @cached_property
    def b_bytes(self) -> list[bytes]:
        b = self.b
        return [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace(META, " ").encode() for i in range(b.get_piece_size())]

    @cached_property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array([*map(len, self.a_bytes)]), np.array([*map(len, self.b_bytes)])

    @cached_property
    def cuts(self) -> bool:
        """Whether no piece of B goes on with a space after another character, so that texts may be cut there."""
        return not any(META in self.b.id_to_piece(i).lstrip(META) for i in range(self.b.get_piece_size()))

    def _encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of each string. B's model puts a space before what it is given, so the string's own first one is left out; of spaces alone it would see nothing."""
        bare = [not c.strip(" ") for c in chunks]
        ids = self.b.encode(["a" + c if x else c[1:] for c, x in zip(chunks, bare, strict=True)], num_threads=1)
        return self._encode_a(chunks), [i[1:] if x else i for i, x in zip(ids, bare, strict=True)]

    def learn(self, chunks: list[str]) -> None:
        """Chunks that end in no white space are encoded many at once, which the cuts allow; where bytes differ, each alone."""
        joined = [c for c in chunks if c[-1] not in WHITE_SPACE] if self.cuts else []
        joined.sort(key=lambda c: SETTLED.fullmatch(c) is None)
        alone = [c for c in chunks if c[-1] in WHITE_SPACE] if self.cuts else chunks
        for lo in range(0, len(joined), TOGETHER):
            some = joined[lo : lo + TOGETHER]
            if not self._take(some, *self._encode(["".join(some)])):
                alone += some
        for lo in range(0, len(alone), TOGETHER):
            some = alone[lo : lo + TOGETHER]
            ids_a, ids_b = self._encode(some)
            if self._take(some, [list(chain.from_iterable(ids_a))], [list(chain.from_iterable(ids_b))]):
                continue
            for c, x, y in zip(some, ids_a, ids_b, strict=True):
                if not self._take([c], [x], [y]):
                    self._keep([c], np.full((1, 4), -1), np.zeros(0, np.int64), [b""])

    def _keep(self, chunks: list[str], stats: np.ndarray, links: np.ndarray, said: list[bytes]) -> None:
        for k, c in enumerate(chunks, len(self.index)):
            self.index[c] = k
        self.said += said
        self.new.append((stats, links))

    def _settle(self) -> None:
        if self.new:
            stats = np.concatenate([s for s, _ in self.new])
            self.link_to = np.concatenate([self.link_to, len(self.links) + np.cumsum(np.maximum(stats[:, 3], 0))])
            self.links, self.stats = np.concatenate([self.links, *(x for _, x in self.new)]), np.concatenate([self.stats, stats])
        self.new = []

    def _take(self, chunks: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> bool:
        """Align consecutive chunks by the tokens of all of them, unless the tokens don't give their bytes."""
        a, b = np.array(ids_a[0], np.int64), np.array(ids_b[0], np.int64)
        raw = [c.encode("utf-8", "replace") for c in chunks]
        whole = b"".join(raw)
        if not len(a) or not len(b) or not whole == b"".join(map(self.a_bytes.__getitem__, ids_a[0])) == b"".join(map(self.b_bytes.__getitem__, ids_b[0])):
            return False
        end_a, end_b, bounds = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b]), np.cumsum([*map(len, raw)])
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        twice = ends[1:] == ends[:-1]
        both, ends = ends[1:][twice], ends[np.append(True, ~twice)]
        links = a[np.searchsorted(end_a, ends)] << 32 | b[np.searchsorted(end_b, ends)]
        n_a, n_b, n_groups, n_links = (_counts(x, bounds) for x in (end_a, end_b, both, ends))
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        width = len(str(max(a.max(), b.max())))
        lines = np.zeros((len(a) + len(b), width + 1), np.uint8)
        for ids, own, others, side, last in ((a, group_a, group_b, "left", b"|"), (b, group_b, group_a, "right", b";")):
            said = _digits(ids, width)
            said[:, width] = np.where(np.append(own[1:] != own[:-1], True), ord(last), ord(","))
            lines[np.arange(len(ids)) + np.searchsorted(others, own, side)] = said
        blob, to = lines[lines != 0].tobytes(), np.cumsum((lines != 0).sum(axis=1))[np.cumsum(n_a + n_b) - 1].tolist()
        self._keep(chunks, np.stack([n_a, n_b, n_groups, n_links], axis=1), links, [blob[x:y] for x, y in zip([0, *to[:-1]], to, strict=True)])
        return True

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], tuple[np.ndarray, ...]]:
        """Counts (a row a text), digests, and the links as (pair, text's place, times) without repeats."""
        if len(self.index) > self.kept:
            self._clear()
        parts = [(split(f" {t}") if self.cuts else [f" {t}"]) if t else [] for t in texts]
        index, said = self.index, self.said
        self.learn(list(set(chain.from_iterable(parts)).difference(index)))
        self._settle()
        stats, digests, none = np.zeros((len(texts), 4), np.int64), [""] * len(texts), (np.zeros(0, np.int64),) * 3
        filled = np.array([i for i, p in enumerate(parts) if p], np.int64)
        if not len(filled):
            return stats, digests, none
        places = [[index[c] for c in p] for p in parts if p]
        chunk = np.fromiter(chain.from_iterable(places), np.int64)
        sizes = np.array([*map(len, places)])
        of, first = self.stats[chunk], np.cumsum(sizes) - sizes
        good = np.minimum.reduceat(of[:, 0], first) >= 0
        stats[filled[good]] = np.add.reduceat(of, first)[good]
        for i, at, well in zip(filled.tolist(), places, good.tolist(), strict=True):
            if well:
                digests[i] = hashlib.sha256(b"".join([said[k] for k in at])[:-1]).hexdigest()
        doc, chunk = np.repeat(filled, sizes)[np.repeat(good, sizes)], chunk[np.repeat(good, sizes)]
        if not len(chunk):
            return stats, digests, none
        key, times = _summed(chunk * len(texts) + doc, np.ones(len(chunk), np.int64))
        chunk, doc = key // len(texts), key % len(texts)
        n = self.stats[chunk, 3]
        take = np.repeat(self.link_to[chunk] - np.cumsum(n), n) + np.arange(n.sum())
        pairs, of_pair = np.unique(self.links[take], return_inverse=True)
        key, times = _summed(of_pair * len(texts) + np.repeat(doc, n), np.repeat(times, n))
        return stats, digests, (pairs[key // len(texts)], key % len(texts), times)


Words = tuple[np.ndarray, np.ndarray, np.ndarray]


def bitmaps(pair: np.ndarray, doc: np.ndarray) -> Words:
    """Of each pair the words of 64 documents that hold it: (pair, word's place, bits), sorted."""
    return or_merge([(pair, doc >> 6, np.uint64(1) << (doc & 63).astype(np.uint64))])


def or_merge(parts: list[Words]) -> Words:
    """Bitmaps of the same documents' numbering, merged by OR."""
    pair, place, bits = (np.concatenate([p[k] for p in parts]) for k in range(3))
    if not len(pair):
        return pair, place, bits
    order = np.lexsort((place, pair))
    pair, place, bits = pair[order], place[order], bits[order]
    first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (place[1:] != place[:-1])))
    return pair[first], place[first], np.bitwise_or.reduceat(bits, first)


def planes(pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> list[Words]:
    """The documents' bitmap and, for each binary digit of times - 1, the bitmap of the documents that have it."""
    out, rest = [bitmaps(pair, doc)], times - 1
    while rest.any():
        out.append(bitmaps(pair[rest & 1 == 1], doc[rest & 1 == 1]))
        rest = rest >> 1
    return out


def weight(plane: int) -> int:
    return 1 << max(0, plane - 1)


PLANE = "struct<ones_n: binary, ones: binary, words_n: binary, places: binary, words: binary>"


def pack(words: Words, pairs: np.ndarray) -> dict[str, bytes]:
    """A plane beside the sorted pairs: words of one document as that document's number, the others as they are."""
    at, place, bits = np.searchsorted(pairs, words[0]), words[1], words[2]
    one = np.bitwise_count(bits) == 1
    low = np.bitwise_count(bits[one] - np.uint64(1)).astype(np.int64)
    return {
        "ones_n": np.bincount(at[one], minlength=len(pairs)).astype("<i4").tobytes(), "ones": (place[one] << 6 | low).astype("<u2").tobytes(),
        "words_n": np.bincount(at[~one], minlength=len(pairs)).astype("<i4").tobytes(), "places": place[~one].astype("<u2").tobytes(), "words": bits[~one].astype("<u8").tobytes(),
    }


def unpack(plane: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(pair's place, document) of each set bit."""
    ones_n, words_n = np.frombuffer(plane["ones_n"], "<i4"), np.frombuffer(plane["words_n"], "<i4")
    of = np.repeat(np.arange(len(words_n)), words_n)
    row, bit = np.nonzero(np.unpackbits(np.frombuffer(plane["words"], np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    place = np.frombuffer(plane["places"], "<u2").astype(np.int64)
    return np.concatenate([np.repeat(np.arange(len(ones_n)), ones_n), of[row]]), np.concatenate([np.frombuffer(plane["ones"], "<u2").astype(np.int64), place[row] << 6 | bit])


class _Block:
    def __init__(self):
        self.ids, self.stats, self.digests, self.planes, self.chars = [], [], [], [], 0

    def add(self, ids: list, stats: np.ndarray, digests: list[str], links: tuple[np.ndarray, ...], chars: int) -> None:
        for k, words in enumerate(planes(links[0], links[1] + len(self.ids), links[2])):
            self.planes[k : k + 1] = [[*(self.planes[k] if k < len(self.planes) else []), words]]
        self.ids += ids
        self.stats.append(stats)
        self.digests += digests
        self.chars += chars

    def row(self, number: int) -> dict:
        merged = [or_merge(parts) for parts in self.planes]
        pairs = np.unique(merged[0][0])
        links, docs = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        for k, (pair, _, bits) in enumerate(merged):
            found = np.bincount(np.searchsorted(pairs, pair), np.bitwise_count(bits), len(pairs)).astype(np.int64)
            links += found * weight(k)
            docs = docs if k else found
        stats = np.concatenate(self.stats)
        return {"block": number, "ids": self.ids, "n_a": stats[:, 0], "n_b": stats[:, 1], "n_groups": stats[:, 2], "n_links": stats[:, 3], "groups_sha256": self.digests, "pairs": pairs, "pair_docs": docs, "pair_links": links, "planes": [pack(m, pairs) for m in merged]}


def postings(docs: DataFrame, model: Aligner, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Blocks of documents with their pairs' bitmaps, one row a block."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner, now, number = held.value, _Block(), TaskContext.get().partitionId() << 32
        for frame in batches:
            ids, texts = [None if pd.isna(x) else x for x in frame["id"].tolist()], frame["text"].tolist()
            for lo, hi in textnum.blocks([t or "" for t in texts]):
                if now.ids and (len(now.ids) + hi - lo > BLOCK_DOCS or now.chars > BLOCK_CHARS):
                    yield pd.DataFrame([now.row(number)])
                    now, number = _Block(), number + 1
                now.add(ids[lo:hi], *aligner.batch(texts[lo:hi]), sum(len(t or "") for t in texts[lo:hi]))
        if now.ids:
            yield pd.DataFrame([now.row(number)])

    kind = docs.schema[doc_id].dataType.simpleString()
    wanted = f"block long, ids array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, pairs array<long>, pair_docs array<long>, pair_links array<long>, planes array<{PLANE}>"
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInPandas(blocks, wanted)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n_docs, n_links, best): popcounts summed over the blocks; best, whether no pair of the same B id has more links."""
    each = blocks.select(F.inline(F.arrays_zip("pairs", "pair_docs", "pair_links")))
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_docs").alias("n_docs"), F.sum("pair_links").alias("n_links"))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    most = counts.groupBy(b).agg(F.max("n_links").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("pair", F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("b").cast("int").alias("b_id"), "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def _scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each block's postings hand its pairs' counts, which come in the order of the pairs, to the documents."""
    for frame in batches:
        sums, bests = [], []
        for planes_, n, counts, best in zip(frame["planes"], frame["n"], frame["counts"], frame["best"], strict=True):
            total, tops = np.zeros((2, n), np.int64)
            counts, best = (np.asarray(x if x is not None else [], np.int64) for x in (counts, best))
            for k, plane in enumerate(planes_):
                pair, doc = unpack(plane)
                np.add.at(total, doc, counts[pair] * weight(k))
                np.add.at(tops, doc, best[pair] * weight(k))
            sums.append(total)
            bests.append(tops)
        yield frame.drop(columns=["planes", "n", "counts", "best"]).assign(n_best=bests, count_sum=sums)


def align(docs: DataFrame, model: Aligner, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """One row a document (its id, counts and scores), and the pairs' counts. Both are read from written tables."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark, "alignment")
    blocks = scratch.result(postings(docs, model, text, doc_id), "blocks")
    counts = scratch.result(pair_counts(blocks), "counts")
    asked = blocks.select("block", F.explode("pairs").alias("pair"))
    answer = asked.join(counts.select("pair", "n_links", F.col("best").cast("long").alias("best")), "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pair", "n_links", "best"))).alias("got"))
    columns = ["ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    joined = blocks.select("block", *columns, "planes").join(answer, "block", "left").select(*columns, "planes", F.size("ids").alias("n"), F.col("got.n_links").alias("counts"), F.col("got.best").alias("best"))
    kinds = ", ".join(f"{c} {joined.schema[c].dataType.simpleString()}" for c in columns)
    scored = joined.mapInPandas(_scores, f"{kinds}, n_best array<long>, count_sum array<long>")
    rows = scored.select(F.inline(F.arrays_zip(*columns, "n_best", "count_sum"))).withColumnRenamed("ids", doc_id)
    return rows.select(doc_id, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), counts.select("a_id", "b_id", "n_docs", "n_links", "best")


def aligner(a_path: str, b_path: str, kept: int = 400_000) -> Aligner:
    """The files are read here and sent to the workers, which need no files."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return Aligner(a.read(), b.read(), kept)
