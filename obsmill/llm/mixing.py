"""Mixing sources to target weights by systematic sampling.

Sources have weights; their targets share all words by weight, none above ``most`` times what the source has
(the excess goes to the others by weight, until none is above). A document's expected copies are its source's
target over its source's words. With the documents of a source in a fixed order (by size, so that the copies
spread over small and large), the prefix sums of the expected copies plus one offset of the source cross
integers, and each crossing emits one copy. The expectation is the same for all documents of a source, so the
prefix sum is the place in the order times the expectation, exact at any size.

The place in the order comes from counts: bands of like size within a source are cut into salts of about
``rows_a_salt`` rows, counted before the shuffle; windows only ever sort one salt.

Defined results: null text has size 0; a null source is a source, the last one. A source without words has
target 0 and emits nothing. Reruns agree: offset and order depend on the rows alone; equal rows are
interchangeable. Repeated rows are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsmill.llm import common

WEIGHTS = (5, 2, 1)
BROADCAST_ROWS = 100_000


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size, rank, target) of rows (source, size).

    The level where no target is above its cap has a closed form: with the sources by cap over weight, the
    first one whose cap is not below its weight times what is left by those before it, over the weights left.
    """
    of = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    ranked = of.withColumn("rank", rank).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("long"))
    ratio = (most * F.col("source_size")) / F.col("weight")
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = ranked.withColumn("ratio", ratio).withColumns({
        "left_size": F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
        "left_weight": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    }).withColumn("level", F.col("left_size") / F.col("left_weight"))
    settled = level.withColumn("settled", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(whole))
    return settled.select("source", "source_size", "rank", F.least(F.col("weight") * F.col("settled.level"), (most * F.col("source_size")).cast("double")).alias("target"))


def _small(df: DataFrame) -> DataFrame:
    """A broadcast hint where the number of rows is checked to be small; else the table as it is."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def copies(docs: DataFrame, text: str = "text", source: str = "source", carry: tuple[str, ...] = (), weights: tuple[int, ...] = WEIGHTS, most: int = 3, rows_a_salt: int = 20_000) -> DataFrame:
    """(doc_id, *carry, source, size, source_size, target, copies, taken) for each row of docs."""
    scratch = common.Scratch(docs.sparkSession, "mixing")
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(common.WORD)), F.lit(0)).cast("long")
    held = scratch.result(docs.select("doc_id", *carry, F.col(source).alias("source"), size.alias("size")), "sizes")
    goal = scratch.result(targets(held), "targets") if (weights, most) == (WEIGHTS, 3) else scratch.result(targets(held, weights, most), "targets")
    banded = held.withColumn("band", F.floor(8 * F.log2(F.col("size") + F.lit(1.0))).cast("int"))
    bands = banded.groupBy("source", "band").count().select(F.col("source").alias("_source"), F.col("band").alias("_band"), F.ceil(F.col("count") / rows_a_salt).alias("salts"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    salted = banded.join(_small(scratch.result(bands, "bands")), same("source", "_source") & (F.col("band") == F.col("_band"))).drop("_source", "_band")
    salted = salted.withColumn("salt", F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)), F.col("salts"))).drop("salts")
    order = Window.partitionBy("source").orderBy("band", "salt").rowsBetween(Window.unboundedPreceding, -1)
    counted = salted.groupBy("source", "band", "salt").count().withColumn("before", F.coalesce(F.sum("count").over(order), F.lit(0)))
    counted = counted.select(F.col("source").alias("_source"), F.col("band").alias("_band"), F.col("salt").alias("_salt"), "before")
    placed = salted.join(_small(scratch.result(counted, "counts")), same("source", "_source") & (F.col("band") == F.col("_band")) & (F.col("salt") == F.col("_salt"))).drop("_source", "_band", "_salt")
    within = Window.partitionBy("source", "band", "salt").orderBy("size", "doc_id", *carry)
    placed = placed.withColumn("place", F.col("before") + F.row_number().over(within) - 1)
    out = placed.join(_small(goal.withColumnRenamed("source", "_source")), same("source", "_source")).drop("_source")
    offset = F.floor(F.pmod((F.col("rank") + 1) * F.lit(0.6180339887498949), F.lit(1.0)) * 1048576) / 1048576.0
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(expected * (F.col("place") + 1) + offset) - F.floor(expected * F.col("place") + offset)
    return out.withColumn("copies", crossed).select("doc_id", *carry, "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """docs, each row as often as the mix takes it."""
    mark = common.fresh(docs, "text_hash")
    counts = copies(docs.select("doc_id", text, source, F.xxhash64(text).alias(mark)), text, source, carry=(mark,))
    total, number, of_id, of_mark, of_source, nth, own, copy = (common.fresh(docs, x) for x in ("total", "number", "of_id", "of_mark", "of_source", "nth", "own", "copy"))
    per = counts.groupBy(F.col("doc_id").alias(of_id), F.col(mark).alias(of_mark), F.col("source").alias(of_source)).agg(F.sum("copies").alias(total), F.count("*").alias(number)).where(F.col(total) > 0)
    on = F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.col(mark) == F.col(of_mark)) & F.col(source).eqNullSafe(F.col(of_source))
    # Rows repeated in the input share their copies: the first ones take what doesn't divide.
    joined = docs.withColumn(mark, F.xxhash64(text)).join(per, on).withColumn(nth, F.row_number().over(Window.partitionBy("doc_id", mark, source).orderBy(F.lit(1))))
    share = F.floor(F.col(total) / F.col(number)) + F.when(F.col(nth) <= F.pmod(F.col(total), F.col(number)), 1).otherwise(0)
    out = joined.withColumn(own, share.cast("int")).where(F.col(own) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(own))))
    return out.select(*docs.columns)
