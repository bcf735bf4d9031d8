"""Shards' files after a rewrite."""

import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from obsmill.llm import common, resharding

DATA = "/root/testdata/sf0.001"


def test_emptied_shards_leave_no_files(spark):
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/shards"
    rows = spark.range(1000).withColumns({"text": F.repeat(F.lit("x"), F.pmod("id", F.lit(50)).cast("int")), "size": F.lit(10).cast("long")})
    old = F.pmod("id", F.lit(16)).cast("int")
    rows.withColumn("shard", old).write.partitionBy("shard").parquet(path)
    assigned = resharding.assign(rows, F.col("id").cast("string"), "size", old, 16, 8)
    resharding.rewrite(assigned, path)
    back = spark.read.parquet(path)
    assert sorted(x for x in os.listdir(path) if x.startswith("shard=")) == sorted(f"shard={k}" for k in range(8))
    want = sorted((r["id"], r["text"], r["shard"]) for r in assigned.collect())
    assert sorted((r["id"], r["text"], r["shard"]) for r in back.collect()) == want


@pytest.mark.parametrize("shards", [8, 16])
def test_reshard_reads_what_it_wrote(spark, shards, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "source")
    written = []
    real = resharding.rewrite
    monkeypatch.setattr(resharding, "rewrite", lambda assigned, path: written.append(path) or real(assigned, path))
    got = resharding.reshard(docs, F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(16)), 16, shards).collect()
    assert written
    raw = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.coalesce("source", F.lit("")).alias("source"))
    plan = resharding.assign(rows, F.struct(common.id_text(), "text_crc32"), "size", F.pmod(F.xxhash64("source"), F.lit(16)), 16, shards).collect()
    names = ("doc_id", "size", "text_crc32", "old_shard", "shard", "slot")
    assert sorted(tuple(r[x] for x in names) for r in got) == sorted(tuple(r[x] for x in names) for r in plan)
