"""Byte-level BPE by longest matches and backtracking.

The bytes of each pre-token are read as Latin-1, so that pyahocorasick finds every vocabulary token at every
place in one pass. Tokens are laid from the left, longest first; a token may follow another only if merging
their joined bytes would not have crossed the boundary (a relation of two tokens, memoised). Where no token
fits, the place is marked dead and the last token is shortened. Each place is left dead at most once, so the
work is linear in the text, and the only surviving path is the result of the merges.

Defined results: null text is the empty text, with no tokens. Long texts and long pre-tokens take linear
time and memory of the text's size. Repeated rows and ids are each encoded; an empty table gives no rows;
other columns pass untouched in ``encode`` and are not read by the query.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterable
from functools import cached_property
from itertools import chain

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmill.llm import common

#: The characters of the White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
FITS = 250_000
ASTRAL = re.compile("[\U00010000-\U0010ffff]")
#: A space beside other white space; without one, every space begins a chunk.
BESIDE = re.compile(f" [{WHITE_SPACE}]|[{WHITE_SPACE}] ")
CHUNK = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _ranges(points: list[int]) -> str:
    """A character class for sorted code points."""
    out, i = [], 0
    while i < len(points):
        j = i
        while j + 1 < len(points) and points[j + 1] == points[j] + 1:
            j += 1
        out.append(f"\\U{points[i]:08x}-\\U{points[j]:08x}")
        i = j + 1
    return "".join(out)


def fast_pattern(pattern: str, last: int = sys.maxunicode) -> re.Pattern:
    """The pattern for the standard engine: properties become explicit classes of the characters up to ``last``."""
    every = "".join(map(chr, (i for i in range(last + 1) if not 0xD800 <= i < 0xE000)))
    classes = {rf"\p{{{p}}}": _ranges([ord(m) for m in regex.findall(rf"\p{{{p}}}", every)]) for p in "LN"}
    out, depth = "", 0
    for part in re.split(r"(\\p\{\w\}|\\s|\\S|\[\^?|\])", pattern):
        if part.startswith("["):
            depth = 1
        elif part == "]":
            depth = 0
        elif part == r"\S":
            part = f"[^{WHITE_SPACE}]"
        elif part == r"\s" or part in classes:
            inner = WHITE_SPACE if part == r"\s" else classes[part]
            part = inner if depth else f"[{inner}]"
        out += part
    return re.compile(out)


class Vocabulary:
    """Tokens, how each came about (the two tokens of its last merge), and its longest shorter prefix."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.ranks = ranks
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.sizes = [len(x) for x in self.bytes_of]
        self.left, self.right = list(range(self.size)), list(range(self.size))
        self.pairs: dict[int, int] = {}
        self.reached: list[int] = []
        for rank in sorted(ranks.values()):
            parts = self._merged(self.bytes_of[rank], rank)
            if len(parts) == 2:
                self.left[rank], self.right[rank] = (ranks[x] for x in parts)
                self.pairs[self.left[rank] << 32 | self.right[rank]] = rank
            if len(parts) <= 2:
                self.reached.append(rank)
        known = {self.bytes_of[r] for r in self.reached}
        self.shorter = [-1] * self.size
        for rank in self.reached:
            token = self.bytes_of[rank]
            self.shorter[rank] = next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in known), -1)

    def _merged(self, token: bytes, below: int) -> list[bytes]:
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


class Encoder:
    """Keeps the tokens of up to ``kept`` chunks and as many pre-tokens a worker (about 250 bytes each)."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, kept: int = 450_000):
        self.v, self.source, self.most = vocabulary, pattern, kept
        self.cache: dict[str, tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.fits: dict[int, bool] = {}

    def __getstate__(self) -> dict:
        return {"v": self.v, "source": self.source, "most": self.most, "cache": {}, "pieces": {}, "fits": {}}

    @cached_property
    def pattern(self) -> re.Pattern:
        return fast_pattern(self.source)

    @cached_property
    def plain(self) -> re.Pattern:
        """The same pattern for texts without supplementary characters: its classes are bitmaps, which are fast."""
        return fast_pattern(self.source, 0xFFFF)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for rank in self.v.reached:
            out.add_word(self.v.bytes_of[rank].decode("latin-1"), (rank, len(self.v.bytes_of[rank]) - 1))
        out.make_automaton()
        return out

    @cached_property
    def decimal(self) -> list[str]:
        return [str(i) for i in range(self.v.size)]

    def _compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b together leaves the boundary between them.

        Merges are undone on both sides, the latest first; a pair at the boundary that would have merged
        before the part undone last was made would have crossed it.
        """
        key = a << 32 | b
        if len(self.fits) > FITS:
            self.fits.clear()
        left, right, pairs, before = self.v.left, self.v.right, self.v.pairs, self.v.size
        verdict = True
        while True:
            joined = pairs.get(a << 32 | b)
            if joined is not None and joined < before:
                verdict = False
                break
            open_a, open_b = left[a] != a, left[b] != b
            if not open_a and not open_b:
                break
            if open_a and (a > b or not open_b):
                before, a = a, right[a]
            else:
                before, b = b + 1, left[b]
        self.fits[key] = verdict
        return verdict

    def _piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8")
        whole = self.v.ranks.get(raw)
        if whole is not None:
            return (whole,)
        longest = [-1] * (len(raw) + 1)
        for end, (token, back) in self.automaton.iter(raw.decode("latin-1")):
            longest[end - back] = token
        sizes, shorter, fits = self.v.sizes, self.v.shorter, self.fits
        alive, out, at, last, goal = bytearray(b"\1") * (len(raw) + 1), [], 0, -1, len(raw)
        token = longest[0]
        while at < goal:
            end = at + sizes[token]
            if alive[end]:
                fit = last < 0 or fits.get(last << 32 | token)
                if fit is None:
                    fit = self._compatible(last, token)
                if fit:
                    out.append(token)
                    at, last, token = end, token, longest[end]
                    continue
            token = shorter[token]
            while token < 0:  # nothing fits here: the place is dead and the last token gets shorter
                alive[at] = 0
                token = out.pop()
                at -= sizes[token]
                last = out[-1] if out else -1
                token = shorter[token]
        return tuple(out)

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        pattern = self.pattern if ASTRAL.search(chunk) else self.plain
        pieces = pattern.findall(chunk)
        kept = self.pieces
        if len(kept) > self.most:
            kept.clear()
        for piece in pieces:
            if piece not in kept:
                kept[piece] = self._piece(piece)
        return tuple(chain.from_iterable(map(kept.__getitem__, pieces)))

    def encode(self, text: str) -> list[int]:
        """Chunks are runs of white space with the run of other characters after it: no pre-token crosses their bounds."""
        if BESIDE.search(text):
            chunks = CHUNK.findall(text)
        else:
            chunks = text.replace(" ", "\0 ").split("\0") if "\0" not in text else CHUNK.findall(text)
        cache = self.cache
        try:
            return list(chain.from_iterable([cache[c] for c in chunks]))
        except KeyError:
            if len(cache) > self.most:
                cache.clear()
            new = set(chunks).difference(cache)
            if len(new) > self.most:
                return list(chain.from_iterable(map(self._chunk, chunks)))
            for c in new:
                cache[c] = self._chunk(c)
            return list(chain.from_iterable([cache[c] for c in chunks]))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.v.bytes_of.__getitem__, ids))


def encoder(path: str, pattern: str, kept: int = 450_000) -> Encoder:
    return Encoder(Vocabulary(load_ranks(path)), pattern, kept)


def digest_udf(spark: SparkSession, model: Encoder):
    """A column function: text to n_tokens, ids_sha256 and decoded_sha256 (of the ids decoded again)."""
    import hashlib

    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(column: pd.Series) -> pd.DataFrame:
        e, rows = held.value, []
        for text in column.tolist():
            ids = e.encode(text or "")
            said = ",".join(map(e.decimal.__getitem__, ids)).encode()
            rows.append((len(ids), hashlib.sha256(said).hexdigest(), hashlib.sha256(e.decode(ids)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests


def encode(docs: DataFrame, model: Encoder, text: str = "text") -> DataFrame:
    """docs with token_ids (array of int), n_tokens and round_trip (whether the ids decode to the text); columns of these names are replaced."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("token_ids array<int>, n_tokens long, round_trip boolean")
    def ids(column: pd.Series) -> pd.DataFrame:
        texts = [t or "" for t in column.tolist()]
        found = [held.value.encode(t) for t in texts]
        same = [held.value.decode(x) == t.encode() for x, t in zip(found, texts, strict=True)]
        return pd.DataFrame({"token_ids": found, "n_tokens": [len(x) for x in found], "round_trip": same})

    names = ("token_ids", "n_tokens", "round_trip")
    kept = [c for c in docs.columns if c not in names]
    place = common.fresh(docs, "encoded")
    return docs.select(*kept, ids(F.col(text)).alias(place)).select(*kept, f"{place}.*")


def decode(docs: DataFrame, model: Encoder, ids: str = "token_ids") -> DataFrame:
    """docs with decoded (binary); null ids give null."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("binary")
    def raw(column: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else held.value.decode(x) for x in column.tolist()], dtype=object)

    return docs.withColumn("decoded", raw(F.col(ids)))
