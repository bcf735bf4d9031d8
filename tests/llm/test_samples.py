"""Bounded samples when ids say nothing, and what is fitted on them."""

import pytest
from pyspark.sql import functions as F

from obsmill.llm import common, language_id

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("doc_id", [1, 2, None])
def test_rows_of_one_id_are_drawn_one_by_one(spark, doc_id):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("lang is not null").withColumn("doc_id", F.lit(doc_id).cast("long"))
    sizes = {r["lang"]: r["n"] for r in docs.select("lang", "text").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    got = {r["lang"]: r["count"] for r in common.bounded_sample(docs.select("doc_id", "text", "lang"), "lang", 5).groupBy("lang").count().collect()}
    assert got == {k: min(5, n) for k, n in sizes.items()}
    model = language_id.fit(docs, per_language=20)
    assert {r[0] for r in language_id.identify(docs, model).select("lang_pred").distinct().collect()} - {"und"}


def test_equal_rows_once_and_the_same_again(spark):
    rows = spark.createDataFrame([(1, "same", "a")] * 3000 + [(i, f"t{i}", "a") for i in range(2000)] + [(5, None, "b"), (6, "x", None)], "doc_id long, text string, lang string")
    first, again = ({tuple(r) for r in common.bounded_sample(rows.repartition(n), "lang", 100).collect()} for n in (1, 7))
    assert first == again and len(first) == 101 and (5, None, "b") in first and all(r[2] for r in first)
    assert common.bounded_sample(rows.limit(0), "lang", 100).collect() == []


def test_clashing_names_of_language(spark):
    docs = spark.createDataFrame([(1, "some words", "mine", "kept", 0.5)], "doc_id long, text string, _language string, language string, lang_pred double")
    got = language_id.identify(docs, None)
    assert got.columns == ["doc_id", "text", "_language", "language", "lang_pred", "lang_score", "lang_coverage"]
    assert got.first()[2:5] == ("mine", "kept", "und")
