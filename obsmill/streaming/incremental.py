"""Incremental cleaning of arriving files and running station-day quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsmill.functions.decode import decode


def clean_arriving(spark: SparkSession, path: str, schema: StructType, identifiers: list[str]) -> DataFrame:
    """A stream of decoded rows from files under path; each file once by the query's checkpoint."""
    rows = spark.readStream.schema(schema).parquet(path)
    for name in identifiers:
        rows = decode(rows, name)
    return rows


def running_quality(rows: DataFrame, passed: str, date: str = "DATE", late: str = "1 day", station: str = "STATION") -> DataFrame:
    """(station, day, n_rows, n_usable) of whole days by the clock of ``date``; rows later than the watermark don't count.

    A time without a zone is put on the scale of instants as if it were of UTC, in whatever zone the session is.
    """
    zoneless = dict(rows.dtypes)[date] == "timestamp_ntz"
    if zoneless:
        rows = rows.withColumn(date, F.from_utc_timestamp(F.col(date).cast("timestamp"), F.current_timezone()))
    counted = rows.withWatermark(date, late).groupBy(station, F.window(date, "1 day")).agg(F.count("*").alias("n_rows"), F.count_if(F.col(passed)).alias("n_usable"))
    start = F.to_utc_timestamp("window.start", F.current_timezone()).cast("timestamp_ntz") if zoneless else F.col("window.start")
    return counted.select(station, start.alias("day"), "n_rows", "n_usable")


def run_available(rows: DataFrame, target: str, checkpoint: str) -> None:
    """Append what a stream has now to a Parquet folder and stop; the checkpoint tells a later run where to go on."""
    rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
