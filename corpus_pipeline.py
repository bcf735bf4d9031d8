"""From raw documents to token ids: the stages of a training-data pipeline.

Each stage takes what the one before kept, as documents, and returns documents; the last adds token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmill.llm import bpe, common, language_id, mixing, quality_classifier, queries, similar


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores under 0.3 go."""
    marks = quality_classifier.training_marks(common.table(spark, sf_dir, "labels"))
    score = quality_classifier.scorer(spark, quality_classifier.fit(docs, marks))
    return docs.where(score(F.col("text")) >= 0.3)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, and those most of whose n-grams belong to no learned language."""
    accepted = language_id.accepter(spark, language_id.fit(language_id.training_rows(docs)))
    return docs.where(accepted(F.col("text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts link at 0.8 or more of their five-word shingles; of each component the document of the smallest doc_id stays."""
    return similar.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their target weights: documents are left out or repeated."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids, which are decoded again to compare."""
    return bpe.encode(docs, queries.tokenizer(kept=150_000))


STAGES = [("quality classifier", quality), ("language ID", language), ("near duplicates", near_duplicates), ("mixing", mix), ("byte-level BPE", encode)]

#: Hashes, floating-point training and byte-pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's result is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.Scratch(spark, f"pipeline-{k}").result(docs)
    return docs
