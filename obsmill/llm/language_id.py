"""Language identification with a bit-sliced Bloom filter of character n-grams.

Every slot of the filter holds one bit a language; the bits that all probes of an n-gram share name the
languages that contain it. The languages' counts over a document, corrected for the filter's false
positives, decide.

Defined results: null text, or text without a letter, gives ``und`` with score 0. Text whose n-grams no
language contains gives the language with the most training documents and score 0. Ties go to the first
language by code point. Repeated rows and repeated ids are each predicted; an empty table gives no rows;
with no training documents every row is ``und``. Other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmill.llm import common, textnum

UNKNOWN = "und"
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)]))
    return _LETTER[0]


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the letter 3- and 4-grams of the lower-cased texts, word edges included, and their documents."""
    low = [t.lower() for t in texts]
    points = np.frombuffer(("\n" + "\n".join(low) + "\n\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])  # of position i + 1
    letter = _letters()[points]
    c = np.where(letter, points, 0).astype(np.uint64)
    three = (c[:-3] << np.uint64(42)) | (c[1:-2] << np.uint64(21)) | c[2:-1]
    mid = letter[1:-2]
    pair = mid & letter[2:-1]
    four = textnum.mix(three[pair]) + (c[3:][pair] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    owner = owner[: len(mid)]
    docs = np.concatenate([owner[mid], owner[pair]])
    return textnum.mix(np.concatenate([textnum.mix(three[mid]), four])), docs


@dataclass
class LanguageFilter:
    languages: list[str]
    default: int
    slots: np.ndarray  # uint8, one row a slot, one bit a language
    false_rate: np.ndarray
    probes: int

    @classmethod
    def build(cls, languages: list[str], default: int, grams: np.ndarray, language: np.ndarray, probes: int = 3, slots_per_gram: int = 12) -> LanguageFilter:
        """grams and language: one entry for each language that an n-gram belongs to."""
        size = 1 << max(10, int(np.ceil(np.log2(max(1, len(np.unique(grams))) * slots_per_gram))))
        slots = np.zeros((size, (len(languages) + 7) // 8), np.uint8)
        for place in cls._places(grams, size, probes):
            np.bitwise_or.at(slots, (place, language // 8), (1 << (language % 8)).astype(np.uint8))
        fill = np.array([((slots[:, i // 8] >> (i % 8)) & 1).mean() for i in range(len(languages))])
        return cls(languages, default, slots, fill**probes, probes)

    @staticmethod
    def _places(grams: np.ndarray, size: int, probes: int) -> list[np.ndarray]:
        mask, step = np.uint64(size - 1), (grams >> np.uint64(40)) | np.uint64(1)
        return [((grams + np.uint64(i) * step) & mask).astype(np.int64) for i in range(probes)]

    def evidence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of n-grams of each text, and how many of them each language contains."""
        n = np.zeros(len(texts))
        hits = np.zeros((len(texts), len(self.languages)))
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        for lo, hi in textnum.blocks(texts, 1 << 20):
            grams, docs = ngrams(texts[lo:hi])
            places = self._places(grams, len(self.slots), self.probes)
            n[lo:hi] = np.bincount(docs, minlength=hi - lo)
            for byte in range(self.slots.shape[1]):
                column = self.slots[:, byte]
                mask = column[places[0]]
                for place in places[1:]:
                    mask &= column[place]
                table = np.bincount(docs * 256 + mask, minlength=256 * (hi - lo)).reshape(-1, 256) @ bits
                width = min(8, len(self.languages) - 8 * byte)
                hits[lo:hi, 8 * byte : 8 * byte + width] = table[:, :width]
        return n, np.maximum(0, (hits - n[:, None] * self.false_rate) / (1 - self.false_rate))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores (the share of the evidence), coverage (the share of n-grams that the language contains)."""
        whole = [t or "" for t in texts]
        n, hits = self.evidence(whole)
        best = np.where(hits.max(axis=1, initial=0) > 0, hits.argmax(axis=1), self.default)
        top = hits[np.arange(len(whole)), best]
        total = hits.sum(axis=1)
        names = [UNKNOWN if not k else self.languages[b] for k, b in zip(n, best, strict=True)]
        return names, np.divide(top, total, out=np.zeros(len(top)), where=total > 0), np.minimum(1, np.divide(top, n, out=np.zeros(len(top)), where=n > 0))


def fit(train: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 1500, least_share: float = 0.02, rival: float = 0.2) -> LanguageFilter | None:
    """Learn the filter from a bounded sample: ``per_language`` whole documents a language at the most.

    An n-gram belongs to a language when ``least_share`` of the language's documents hold it, and its share
    is ``rival`` times that of the language where it is most common, or more. A document of average
    size G distinct n-grams bounds what reaches the driver: G / least_share entries a language.
    """
    rows = train.select("doc_id", F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    rows = common.bounded_sample(rows, "lang", per_language)
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    rank = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, of = pdf["text"].tolist(), pdf["lang"].map(rank).to_numpy()
            for lo, hi in textnum.blocks(texts, 1 << 20):
                grams, docs = ngrams(texts[lo:hi])
                order = np.lexsort((grams, docs))
                grams, docs = grams[order], docs[order]
                first = np.ones(len(grams), bool)
                first[1:] = (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])
                out = pd.DataFrame({"gram": grams[first].view(np.int64), "language": of[lo:hi][docs[first]]})
                yield out.groupby(["gram", "language"]).size().rename("docs").reset_index()

    seen = rows.select("text", "lang").mapInPandas(count, "gram long, language int, docs long").groupBy("gram", "language").agg(F.sum("docs").alias("docs"))
    share = seen.withColumn("share", F.col("docs") / F.element_at(F.array(*[F.lit(float(sizes[x])) for x in languages]), F.col("language") + 1))
    tops = share.groupBy("gram").agg(F.max("share").alias("top"), F.collect_list(F.struct("share", "language")).alias("all"))
    kept = tops.where(F.col("top") >= least_share).select("gram", "top", F.explode("all").alias("x"))
    found = kept.where((F.col("x.share") >= least_share) & (F.col("x.share") >= rival * F.col("top"))).select("gram", F.col("x.language").alias("language")).toPandas()
    return LanguageFilter.build(languages, rank[max(languages, key=lambda x: (sizes[x], x))], found["gram"].to_numpy(np.int64).view(np.uint64), found["language"].to_numpy(np.int64))


def identify(docs: DataFrame, model: LanguageFilter | None, text: str = "text") -> DataFrame:
    """docs with lang_pred, lang_score and lang_coverage, in place of columns of these names; every other column passes."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, lang_score double, lang_coverage double")
    def predict(column: pd.Series) -> pd.DataFrame:
        if held.value is None:
            return pd.DataFrame({"lang_pred": UNKNOWN, "lang_score": 0.0, "lang_coverage": 0.0}, index=column.index)
        names, score, coverage = held.value.predict(column.tolist())
        return pd.DataFrame({"lang_pred": names, "lang_score": score, "lang_coverage": coverage})

    place = common.fresh(docs, "language")
    kept = [c for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_coverage")]
    return docs.select(*kept, predict(F.col(text)).alias(place)).select(*kept, f"{place}.*")


def accepter(spark: SparkSession, model: LanguageFilter | None, least_coverage: float = 0.2):
    """A column function: whether a text has a language and the language holds that share of its n-grams."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accepted(column: pd.Series) -> pd.Series:
        if held.value is None:
            return pd.Series([False] * len(column))
        names, _, coverage = held.value.predict(column.tolist())
        return pd.Series([n != UNKNOWN and c >= least_coverage for n, c in zip(names, coverage, strict=True)])

    return accepted


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(common.fold(4) != 2)
