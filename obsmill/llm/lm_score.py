"""Language-model scores from a log-frequency Bloom filter, and smoothed unigram scores.

The model predicts the lower-cased words (A-Z) of a text and its end token from the word before. Its unigrams are
those of the base score, so that words never met in training are one class to both. Counts of pairs of words, over
all training documents, are summed by Spark and held quantised in the filter: a pair's count, rounded down to a
power of two, as a chain of entries that is probed until one is missing.

A pair that is held as q, after a context (the word before) of S tokens, has the probability q / (S + T + E), where
T = S ** ``spread`` stands for the different words that follow a context; for others of a context that was met the
unigram counts, times T / (S + T + E). As S is no less than the sum of q, the probabilities of all next tokens sum
to one or less; E is what the false positives of all distinct words are expected to add to q. The first entry of a
pair's chain is probed so many more times, the larger the corpus is, that E stays small.

A model that grows with its corpus can't be broadcast at every size, and passing it on filter by filter takes a
pass over the texts for each. So the probes go to the filter: texts are cut into portions, and each portion asks
once for each of its different words and pairs. Keys are dealt to slices by their hash, and all portions' questions
about a slice meet in one group, which sums their training counts, builds the slice's filter of ``filter_bytes`` or
less, probes it and answers: a word by its exact count, a pair by the length of its chain, one byte. Answers go
back to the portions, whose token numbers were kept. So each text is read once, pairs move once and nothing but
the totals passes through the driver. However frequent a word or pair is, it is one question of a portion.

Messages are as many as portions times slices; both bounds are to be raised with the workers' memory at large sizes.

Defined results: null and empty text is the end token alone. Without training documents, N and V are 0, every
token's probability is 0.1 / 0.1, and both scores are 0. Repeated rows and ids are each scored, null ids included;
an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmill.llm import common, textnum

SPREAD = 0.8
#: Hash of the end token, which also stands before a text; no word is hashed to it but by chance of 2 ** -64.
END_HASH = np.uint64(1)
BLOCK_BITS = 19
PROBES = 10  # of entries other than the first of a pair
LEAST_SLICES = 64
SENT_BITS = 28  # of a pair's key, beside those of the number of bytes
RECORD, TOTALS = -1, -1  # the slice of a portion's own row, and the portion of a slice's totals
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts in order, each text's end token included, and the text of each."""
    buf, starts = textnum.joined(texts, lower=True)
    begin, end = textnum.words(buf)
    owner = np.searchsorted(starts, begin, "right") - 1
    hashes = np.concatenate([textnum.word_hashes(buf, begin, end), np.full(len(texts), END_HASH)])
    owner = np.concatenate([owner, np.arange(len(texts))])
    order = np.argsort(owner, kind="stable")
    return hashes[order], owner[order]


def pairs_of(words: np.ndarray, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each token (a place in the sorted ``words``) the place of the word before, and the pair's key."""
    before = np.r_[0, tokens[:-1]]
    before[np.cumsum(lengths) - lengths] = 0  # the end token's hash is the least
    return before, textnum.mix(textnum.mix(words)[before] + words[tokens])


def cuts(keys: np.ndarray, slices: int) -> np.ndarray:
    """Where each slice begins and ends in sorted keys."""
    return np.searchsorted(((keys >> _HALF) * np.uint64(slices)) >> _HALF, np.arange(slices + 1))


def packed(x: np.ndarray) -> bytes:
    """Whole numbers by their bytes' places, compressed: most counts are small, and most upper bytes are zero."""
    return zlib.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as what each is above the one before."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def spare_bits(text_bytes: int) -> int:
    """Bits of a pair's key that needn't be sent: the others are so many more than the corpus has bytes that few pairs of a slice fall together."""
    return max(0, 64 - SENT_BITS - text_bytes.bit_length())


def first_probes(text_bytes: int) -> int:
    """Probes of a pair's first entry: a different word in every 16 bytes of text, or fewer, make E one at most."""
    return max(PROBES, (text_bytes >> 4).bit_length())


class LogFrequencyFilter:
    """Chains of entries in blocks of 64 KB; about half of the bits are set."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, first: int):
        """keys: sorted, each once; first: probes of the first entry of a chain."""
        levels = np.frexp(counts)[1]
        n_probes = first * len(keys) + PROBES * int((levels - 1).sum())
        self.first, self.n_blocks = first, max(1, -(-int(n_probes / np.log(2)) >> BLOCK_BITS))
        bits = np.zeros(self.n_blocks << BLOCK_BITS, bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            of = keys[levels >= level]
            for lo in range(0, len(of), 1 << 16):
                for bit in self.places(of[lo : lo + (1 << 16)], level):
                    bits[bit] = True
        self.fill = float(bits.mean())
        self.bits = np.packbits(bits, bitorder="little")

    def walk(self, keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The block's first bit, where an entry's bits begin within it, the first step, and by how much steps grow."""
        block = ((keys >> _HALF) * np.uint64(self.n_blocks)) >> _HALF
        h = textnum.mix(keys + np.array([level], np.uint64) * _GOLDEN)
        return block << np.uint64(BLOCK_BITS), h, (h >> np.uint64(BLOCK_BITS)) | np.uint64(1), h >> np.uint64(2 * BLOCK_BITS)

    def probes(self, level: int) -> int:
        return self.first if level == 1 else PROBES

    def places(self, keys: np.ndarray, level: int) -> Iterator[np.ndarray]:
        base, h, step, growth = self.walk(keys, level)
        for _ in range(self.probes(level)):
            yield (base + (h & np.uint64((1 << BLOCK_BITS) - 1))).astype(np.int64)
            h, step = h + step, step + growth

    def holds(self, keys: np.ndarray, level: int) -> np.ndarray:
        mask, live = np.uint64((1 << BLOCK_BITS) - 1), np.arange(len(keys))
        base, h, step, growth = self.walk(keys, level)
        for _ in range(self.probes(level)):
            bit = base + (h & mask)
            hit = (self.bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            if not hit.all():
                live, base, h, step, growth = live[hit], base[hit], h[hit], step[hit], growth[hit]
            h, step = h + step, step + growth
        out = np.zeros(len(keys), bool)
        out[live] = True
        return out

    def chain(self, keys: np.ndarray) -> np.ndarray:
        """How many entries of a chain are held from its first on; the one after the first missing isn't probed."""
        out = np.zeros(len(keys), np.uint8)
        for lo in range(0, len(keys), 1 << 16):
            part = keys[lo : lo + (1 << 16)]
            live = np.arange(len(part))
            for level in range(1, 64):
                live = live[self.holds(part[live], level)]
                if not len(live):
                    break
                out[lo + live] = level
        return out

    def false_share(self) -> float:
        """The share of pairs not held that seem to be."""
        return self.fill**self.first


def logs(count: np.ndarray, tokens: np.ndarray, before: np.ndarray, levels: np.ndarray, norm: float, false: float, spread: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 of each token's probability by its unigram and by the model, from counts of words and the tokens' chains."""
    base = (np.log10(count + 0.1) - norm)[tokens]
    total = count.astype(np.float64)[before]
    met, follow = total > 0, total**spread
    q = np.minimum(np.where(levels > 0, 2.0 ** (levels.astype(np.int64) - 1), 0), total)  # no more than S, whatever the filter adds falsely
    whole = np.where(met, total + follow + false, 1.0)
    backed = np.log10(np.where(met, np.where(q > 0, q, follow), 1.0) / whole)
    return base, np.where(q > 0, backed, backed + base)


def dealt(docs: DataFrame, slices: int, spare: int, portion_bytes: int) -> DataFrame:
    """Of rows (doc_id, text, train): each portion's own row (ids, tokens of each text, words, token numbers) and its questions to the slices."""

    def portion(number: int, ids: list, raw: list[bytes], train: list[bool]) -> pd.DataFrame:
        hashes, lengths = [], []
        for lo, hi in textnum.blocks(raw):
            h, owner = tokens_of(raw[lo:hi])
            hashes.append(h)
            lengths.append(np.bincount(owner, minlength=hi - lo))
        n = np.concatenate(lengths)
        words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
        learned = np.repeat(np.array(train, bool), n)
        pairs, of = np.unique(pairs_of(words, tokens, n)[1], return_inverse=True)
        word_n, pair_n = np.bincount(tokens[learned], minlength=len(words)).astype(np.int32), np.bincount(of[learned], minlength=len(pairs)).astype(np.int32)
        rows = [(number, RECORD, ids, packed(n.astype(np.int32)), packed(tokens.astype(np.int32)), packed_keys(words), None, None, None)]
        at, pair_at = cuts(words, slices), cuts(pairs, slices)
        for k in np.flatnonzero((np.diff(at) > 0) | (np.diff(pair_at) > 0)):
            w, p = slice(at[k], at[k + 1]), slice(pair_at[k], pair_at[k + 1])
            rows.append((number, int(k), None, None, None, packed_keys(words[w]), packed(word_n[w]), packed_keys(pairs[p] >> np.uint64(spare)), packed(pair_n[p])))
        return pd.DataFrame(rows, columns=["portion", "slice", "ids", "lengths", "tokens", "words", "word_n", "pairs", "pair_n"])

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, size, held = TaskContext.get().partitionId() << 32, 0, ([], [], [])
        for pdf in batches:
            for doc_id, text, train in zip(pdf["doc_id"], pdf["text"], pdf["train"], strict=True):
                raw = textnum.encode(text)
                for kept, x in zip(held, (doc_id, raw, train), strict=True):
                    kept.append(x)
                size += len(raw) + 8
                if size >= portion_bytes:
                    yield portion(number, *held)
                    number, size, held = number + 1, 0, ([], [], [])
        if size:
            yield portion(number, *held)

    columns = "portion long, slice int, ids array<string>, lengths binary, tokens binary, words binary, word_n binary, pairs binary, pair_n binary"
    return docs.mapInPandas(deal, columns)


def answers(questions: DataFrame, first: int) -> DataFrame:
    """(portion, slice, word_n, levels) of questions, and of each slice (TOTALS, slice) with its counts' sum, its different words and its false share."""

    def answer(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        whole = lambda column: np.concatenate([unpacked(x, np.int32) for x in pdf[column]])
        asked = [unpacked_keys(x) for x in pdf["words"]]
        words, which = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(which, whole("word_n"), len(words)).astype(np.int64)
        asked_pairs = [unpacked_keys(x) for x in pdf["pairs"]]
        pairs, pair = np.unique(textnum.mix(np.concatenate(asked_pairs)), return_inverse=True)  # by block from here on
        pair_total = np.bincount(pair, whole("pair_n"), len(pairs)).astype(np.int64)
        held = LogFrequencyFilter(pairs[pair_total > 0], pair_total[pair_total > 0], first)
        word_at, pair_at = np.cumsum([len(x) for x in asked])[:-1], np.cumsum([len(x) for x in asked_pairs])[:-1]
        out = pd.DataFrame({
            "portion": pdf["portion"].to_numpy(),
            "slice": key[0],
            "word_n": [packed(x) for x in np.split(total[which], word_at)],
            "levels": [packed(x) for x in np.split(held.chain(pairs)[pair], pair_at)],
            "n": 0, "v": 0, "false": 0.0,
        })
        own = pd.DataFrame({"portion": [TOTALS], "slice": [key[0]], "word_n": [b""], "levels": [b""], "n": [int(total.sum())], "v": [int((total > 0).sum())], "false": [held.false_share()]})
        return pd.concat([out, own])

    return questions.select("portion", "slice", "words", "word_n", "pairs", "pair_n").groupBy("slice").applyInPandas(answer, "portion long, slice int, word_n binary, levels binary, n long, v long, false double")


def score(docs: DataFrame, train: Column, text: str = "text", spread: float = SPREAD, filter_bytes: int = 1 << 24, portion_bytes: int = 1 << 23) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each row of docs; the model learns from rows where train holds."""
    spark = docs.sparkSession
    with common.Scratch(spark, "lm") as scratch:
        text_bytes, n_rows = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count("*")).first()
        if not n_rows:
            none = {"n_tokens": "long", "n_known": "long", "train_tokens": "long", "base_score": "double", "score": "double"}
            return docs.limit(0).select("doc_id", *[F.lit(None).cast(kind).alias(name) for name, kind in none.items()])
        slices = max(LEAST_SLICES, -(-text_bytes // (2 * filter_bytes)))  # two bytes of text or more for one of filter
        # ids pass as text, since null ones would make doubles of them
        rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
        parts, kind = dealt(rows, slices, spare_bits(text_bytes), portion_bytes), F.when(F.col("slice") == RECORD, "own").otherwise("asked")
        parts.withColumn("kind", kind).write.partitionBy("kind").parquet(scratch.folder("portions"))
        of = lambda kind: spark.read.schema(parts.schema).parquet(f"{scratch.root}/portions/kind={kind}")
        answered = scratch.table(answers(of("asked"), first_probes(text_bytes)), "answers")
        common.remove(spark, f"{scratch.root}/portions/kind=asked")  # half of what is on disk
        whole = answered.where(F.col("portion") == TOTALS).agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.avg("false").alias("false")).first()
        total, distinct = whole["n"] or 0, whole["v"] or 0
        norm, false = float(np.log10(total + 0.1 * (distinct + 1))), distinct * (whole["false"] or 0.0)

        def finish(own: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
            mine, told = own.iloc[0], told.sort_values("slice")
            n, tokens, words = unpacked(mine["lengths"], np.int32), unpacked(mine["tokens"], np.int32), unpacked_keys(mine["words"])
            count, levels = np.concatenate([unpacked(x, np.int64) for x in told["word_n"]]), np.concatenate([unpacked(x, np.uint8) for x in told["levels"]])
            before, keys = pairs_of(words, tokens, n)
            base, model = logs(count, tokens, before, levels[np.unique(keys, return_inverse=True)[1]], norm, false, spread)
            owner = np.repeat(np.arange(len(n)), n)
            summed = lambda x: np.bincount(owner, x, len(n))
            return pd.DataFrame({"doc_id": list(mine["ids"]), "n_tokens": n.astype(np.int64), "n_known": summed(count[tokens] > 0).astype(np.int64), "base_score": summed(base), "score": summed(model)})

        own = of("own").select("portion", "ids", "lengths", "tokens", "words")
        told = answered.where(F.col("portion") != TOTALS).select("portion", "slice", "word_n", "levels")
        out = own.groupBy("portion").cogroup(told.groupBy("portion")).applyInPandas(finish, "doc_id string, n_tokens long, n_known long, base_score double, score double")
        out = out.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
        return common.Scratch(spark, "lm-scores").result(out)
