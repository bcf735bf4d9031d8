"""Runs of missing values, found in blocks of a station and year and put together over their seams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def missing_runs(df: DataFrame, column: str, date: str = "DATE", order: str = "obs_id", station: str = "STATION") -> DataFrame:
    """(station, run, length, begin, end): all runs of nulls. A run's number is the count of values before it in the station.

    In a block, a run is told apart by the values seen before it there. Added to the values of the station's earlier
    blocks, this gives pieces of a run over several blocks the same number. The window over blocks has one row a year.
    """
    rows = df.where(F.col(date).isNotNull()).select(station, F.col(date).alias("at"), F.col(order).alias("nth"), F.col(column).alias("x"), F.year(date).alias("block"))
    seen = F.count("x").over(Window.partitionBy(station, "block").orderBy("at", "nth"))
    missing = F.col("x").isNull()
    pieces = rows.withColumn("seen", seen).groupBy(station, "block", "seen").agg(F.count_if(missing).alias("length"), F.min(F.when(missing, F.col("at"))).alias("begin"), F.max(F.when(missing, F.col("at"))).alias("end"))
    blocks = pieces.groupBy(station, "block").agg(F.max("seen").alias("values"))
    before = F.sum("values").over(Window.partitionBy(station).orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    placed = pieces.where("length > 0").join(blocks.select(station, "block", F.coalesce(before, F.lit(0)).alias("before")), [station, "block"])
    return placed.groupBy(station, (F.col("before") + F.col("seen")).alias("run")).agg(F.sum("length").alias("length"), F.min("begin").alias("begin"), F.max("end").alias("end"))


def longest_missing_run(df: DataFrame, column: str, date: str = "DATE", order: str = "obs_id", station: str = "STATION") -> DataFrame:
    """(station, length, begin, end, hours) of each station's longest run of nulls, the first one on ties."""
    runs = missing_runs(df, column, date, order, station)
    best = runs.groupBy(station).agg(F.max_by(F.struct("length", "begin", "end"), F.struct("length", -F.col("run"))).alias("x"))
    return best.select(station, "x.*").withColumn("hours", (F.unix_timestamp("end") - F.unix_timestamp("begin")) / 3600.0)
