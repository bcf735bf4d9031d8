"""Quality classifier: averaged vectors of hashed words and character n-grams, softmax output, numpy SGD.

A document is the mean of the vectors of its words, of its byte 3- to 5-grams and of one marker for each word
equal to the word before it. Since the output is linear in that mean, scoring reads one number a bucket and
class (vectors times output weights), which is the same result.

Defined results: null and empty texts score as the output bias alone says. Without labelled rows, or with one
class alone, every score is that class's (0.5 without rows). Repeated rows and ids are each scored; a document
with several labels counts once for each; rows whose label is null don't count. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmill.llm import common, textnum

WORD_BITS, GRAM_BITS = 15, 16
BUCKETS = (1 << WORD_BITS) + (1 << GRAM_BITS) + 1
REPEAT = BUCKETS - 1


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word and n-gram of the texts, and the text of each."""
    buf, starts = textnum.joined(texts, gap=4)
    begin, end = textnum.words(buf)
    hashes = textnum.word_hashes(buf, begin, end)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 4 for t in texts])  # of place i + 4
    word_owner = owner[begin - 4]
    same = (hashes[1:] == hashes[:-1]) & (word_owner[1:] == word_owner[:-1])
    ids, docs = [(hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), np.full(same.sum(), REPEAT)], [word_owner, word_owner[1:][same]]
    inside = np.arange(len(buf) - 8) + 4
    owner = owner[: len(inside)]
    gram = buf[4:-4].astype(np.uint64)
    for k in range(1, 5):
        gram = (gram << np.uint64(8)) | buf[4 + k : len(buf) - 4 + k]
        if k >= 2:
            whole = inside + k < (starts + [len(t) for t in texts])[owner]
            hashed = (gram[whole] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAM_BITS)
            ids.append(hashed.astype(np.int64) + (1 << WORD_BITS))
            docs.append(owner[whole])
    return np.concatenate(ids), np.concatenate(docs)


@dataclass
class Classifier:
    weights: np.ndarray  # by bucket: log odds of the upper class
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        raw = [textnum.encode(t) for t in texts]
        out = np.full(len(raw), self.bias)
        for lo, hi in textnum.blocks(raw, 1 << 20):
            ids, docs = features(raw[lo:hi])
            n = np.bincount(docs, minlength=hi - lo)
            out[lo:hi] += np.bincount(docs, self.weights[ids], hi - lo) / np.maximum(n, 1)
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int = 16, epochs: int = 10, batch: int = 32, rate: float = 1.0, seed: int = 5) -> Classifier:
    """Stochastic gradient descent on (buckets, counts, label) rows, in mini-batches, with a falling rate."""
    labels = {r[2] for r in rows}
    if len(labels) < 2:
        return Classifier(np.zeros(BUCKETS), 0.0 if not labels else (6.0 if 1 in labels else -6.0))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / size, 1 / size, (BUCKETS, size)).astype(np.float32).T.copy()  # by dimension, so that a step holds one number a bucket at a time
    out, bias = np.zeros((size, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * ((len(rows) + batch - 1) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(rows), batch):
            part = [rows[i] for i in order[lo : lo + batch] if len(rows[i][0])]
            if not part:
                continue
            ids = np.concatenate([r[0] for r in part]).astype(np.int32)
            first = np.cumsum([0, *[len(r[0]) for r in part[:-1]]])
            share = np.concatenate([r[1] / r[1].sum() for r in part]).astype(np.float32)
            mean = np.stack([np.add.reduceat(v[ids] * share, first) for v in vectors], axis=1)
            z = mean @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), [r[2] for r in part]] -= 1
            step = np.float32(rate * (1 - done / steps) * 8)
            owner = np.repeat(np.arange(len(part), dtype=np.int32), [len(r[0]) for r in part])
            for v, back in zip(vectors, (p @ out.T).T, strict=True):
                v -= step * np.bincount(ids, back[owner] * share, BUCKETS).astype(np.float32)
            out -= step * (mean.T @ p) / len(part)
            bias -= step / 8 * p.mean(axis=0)
            done += 1
    logits = vectors.T @ out
    return Classifier((logits[:, 1] - logits[:, 0]).astype(np.float64), float(bias[1] - bias[0]))


def fit(docs: DataFrame, marks: DataFrame, text: str = "text", most: int = 1000) -> Classifier:
    """Fit on a bounded sample: the documents of ``most`` ids of each label at the most, chosen by a hash.

    marks has doc_id and label. The sample is drawn from it, so that it, not the texts, is what is sent around;
    an id that several documents share stands for the greatest of their texts. What sampling changes in the
    labels' shares is put back into the output bias. One task learns from it; only the weights reach the driver.
    """
    known = marks.where("doc_id is not null and label is not null").select("doc_id", (F.col("label") > 0).cast("int").alias("label"))
    totals = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    drawn = common.bounded_sample(known, "label", most).distinct()
    sample = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text_, label_ in zip(pdf["text"], pdf["label"], strict=True):
                ids, _ = features([textnum.encode(text_)])
                unique, n = np.unique(ids, return_counts=True)
                yield pd.DataFrame({"ids": [unique.astype(np.uint32).tobytes()], "n": [n.astype(np.uint32).tobytes()], "label": [label_]})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32).astype(np.float32), int(y)) for pdf in batches for a, b, y in zip(pdf["ids"], pdf["n"], pdf["label"], strict=True)]
        rows.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes()))
        model = train(rows)
        yield pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    counted = sample.mapInPandas(count, "ids binary, n binary, label int")
    learned = counted.repartition(1).mapInPandas(learn, "weights binary, bias double").first()
    model = Classifier(np.frombuffer(learned["weights"], np.float64), learned["bias"]) if learned else train([])
    if len(totals) == 2:
        model.bias += np.log(max(1.0, totals[1] / most)) - np.log(max(1.0, totals[0] / most))
    return model


def scorer(spark: SparkSession, model: Classifier):
    """A column function: text to the probability of label 1."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(column: pd.Series) -> pd.Series:
        return pd.Series(held.value.scores(column.tolist()))

    return scores


def score(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """docs with quality_score."""
    return docs.withColumn("quality_score", scorer(docs.sparkSession, model)(F.col(text)))


def training_marks(labels: DataFrame) -> DataFrame:
    """The labels outside the hold-out: doc_id, label."""
    return labels.where(common.fold(5) != 0).select("doc_id", F.col("quality").alias("label"))
