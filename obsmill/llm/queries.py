"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmill.llm import alignment, bpe, common, html_extract, language_id, lm_score, media, mixing, neighbours, oracles, quality_classifier, quality_rules, resharding, simhash, vector_codes


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = language_id.fit(language_id.training_rows(docs))
    out = language_id.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (common.fold(4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_coverage").alias("coverage"))


def tokenizer(kept: int = 450_000) -> bpe.Encoder:
    import public_tokenizers

    return bpe.encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, kept)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    digests = bpe.digest_udf(spark, tokenizer())
    return docs.select("doc_id", digests("text").alias("x")).select("doc_id", "x.*")


def op3_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law bytes. The old shards are the sources' hashes, which are as uneven as the sources. Files are rewritten and read back."""
    docs = common.table(spark, sf_dir, "documents")
    out = resharding.reshard(docs.select("doc_id", "text", "source"), F.pmod(F.xxhash64("source"), F.lit(16)), 16, 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return quality_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs.select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, quality_classifier.training_marks(common.table(spark, sf_dir, "labels")))
    out = quality_classifier.score(docs, model)
    return out.select("doc_id", (common.fold(5) == 0).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return docs.select("doc_id", media.media_columns(F.col("text")).alias("m")).select("doc_id", "m.*")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages")
    out = html_extract.extract(pages.select("page_id", "url", "html"), html_extract.fit(pages))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return mixing.copies(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    out = lm_score.score(docs, common.fold(10) != 0)
    return out.select("doc_id", (common.fold(10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors.select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents")
    model = alignment.aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.align(docs.select("doc_id", "text"), model)[0]


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    coded, books = vector_codes.compress(vectors.select("vec_id", "embedding", "label"))
    out = vector_codes.label_errors(coded)
    return out.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(vector_codes.codebooks_sha256(books)).alias("codebooks_sha256"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
