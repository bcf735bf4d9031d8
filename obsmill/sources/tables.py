"""Reading and writing of observation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cells that count as absent in delimited files.
ABSENT = ("", "NA", "N/A", "NULL", "null", "NaN", "nan", "None", "n/a", "#N/A", "<NA>")


def read_csv(spark: SparkSession, path: str, columns: list[str], absent: tuple[str, ...] = ABSENT) -> DataFrame:
    """All columns as text, absent cells as null; the schema is given, never inferred."""
    df = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(path, header=True)
    return df.select(*[F.when(~F.col(c).isin(*absent), F.col(c)).alias(c) for c in columns])


def fixed(number: Column, digits: int) -> Column:
    """A double as text of ``digits`` decimals, null as null, rounded as printf does: by the exact binary value, ties to even.

    Spark's format_string, round and bround all start from the shortest decimal text of a double, so that
    6959.15, which is a little less than that, becomes 6959.2 there.
    """

    @F.udf("string")
    def text(x: float | None) -> str | None:
        return None if x is None else f"{x:.{digits}f}"

    return text(number.cast("double"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def stack_years(frames: dict[int, DataFrame]) -> DataFrame:
    """Yearly tables as one, by column name, with YEAR."""
    out = None
    for year in sorted(frames):
        part = frames[year].withColumn("YEAR", F.lit(year))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def write_sorted(df: DataFrame, path: str, keys: list[str], kind: str = "parquet") -> None:
    """Range-partitioned and sorted by keys; reruns give the same files' rows in the same order."""
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = ordered.write.mode("overwrite")
    writer.csv(path, header=True, nullValue="", emptyValue="") if kind == "csv" else writer.option("compression", "snappy").parquet(path)
