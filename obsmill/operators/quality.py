"""Completeness, sentinel and usability statistics, their distributions, and lists of extremes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


def completeness(df: DataFrame, columns: list[str], station: str = "STATION") -> DataFrame:
    """(station, field, n_rows, n_null, completeness) in one pass over df."""
    agg = df.groupBy(station).agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = agg.unpivot([station, "n_rows"], columns, "field", "n_null")
    return long.withColumn("completeness", 1 - F.col("n_null") / F.col("n_rows"))


def reasons(df: DataFrame, verdicts: dict[str, str], station: str = "STATION") -> DataFrame:
    """(station, field, reason, n): how often each field failed, by reason."""
    pairs = F.array(*[F.struct(F.lit(k).alias("field"), F.col(v)["reason"].alias("reason")) for k, v in verdicts.items()])
    return df.select(station, F.explode(pairs).alias("x")).select(station, "x.*").where("reason is not null").groupBy(station, "field", "reason").agg(F.count("*").alias("n"))


def station_years(df: DataFrame, usable: str, station: str = "STATION", year: str = "year") -> DataFrame:
    return df.groupBy(station, year).agg(F.count("*").alias("n_rows"), F.count_if(F.col(usable)).alias("n_usable")).withColumns({"n_lost": F.col("n_rows") - F.col("n_usable"), "usable_rate": F.col("n_usable") / F.col("n_rows")})


def distribution(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Exact, interpolated percentiles, as sketches don't match. Equal values are counted first; all marks share one buffer."""
    x, n = F.col("value"), F.col("times")
    counted = df.select(*by, F.col(column).alias("value")).groupBy(*by, "value").agg(F.count("value").alias("times"))
    marks = F.percentile(x, F.array(*map(F.lit, MARKS.values())), n)
    made = counted.groupBy(*by).agg(F.sum("times").alias("n"), F.min(x).alias("low"), F.max(x).alias("high"), F.try_divide(F.sum(x * n), F.sum("times")).alias("mean"), marks.alias("marks"))
    return made.select(*by, "n", "low", "high", "mean", *[F.col("marks")[k].alias(m) for k, m in enumerate(MARKS)])


def metric_rows(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(metric, value) of a column of each table, those that aren't numbers left out."""
    out = None
    for metric, (df, column) in tables.items():
        value = F.col(column).try_cast("double") if dict(df.dtypes)[column] == "string" else F.col(column).cast("double")
        part = df.select(F.lit(metric).alias("metric"), value.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
        out = part if out is None else out.unionAll(part)
    return out


def extremes(df: DataFrame, by: str, columns: list[str], ascending: bool, most: int = 10) -> DataFrame:
    """(place, *columns): the rows of the highest (or lowest) values of ``by``, ties by the other columns; Spark keeps ``most`` rows a task."""
    others = [F.col(c).asc() for c in columns if c != by]
    first = df.where(F.col(by).isNotNull()).orderBy(F.col(by).asc() if ascending else F.col(by).desc(), *others).limit(most).select(*columns)
    fields = F.struct(*[(F.col(c) if c != by or ascending else -F.col(c)).alias(c) for c in [by, *[c for c in columns if c != by]]])
    listed = first.agg(F.array_sort(F.collect_list(fields)).alias("rows")).select(F.posexplode("rows").alias("at", "row"))
    return listed.select((F.col("at") + 1).alias("place"), *[(F.col(f"row.{c}") if c != by or ascending else -F.col(f"row.{c}")).alias(c) for c in columns])


def assessment(tables: dict[str, tuple[DataFrame, str]], lists: dict[str, tuple[DataFrame, str, list[str], bool]], most: int = 10) -> DataFrame:
    """(section, name, place, subject, n, low, high, mean and the marks): the distribution of each metric, then each list's rows.

    A list's row has its value as low and high, and its other columns, joined by a bar, as subject.
    """
    spread = distribution(metric_rows(tables), "value", ["metric"])
    marks = ["n", "low", "high", "mean", *MARKS]
    out = spread.select(F.lit("distribution").alias("section"), F.col("metric").alias("name"), F.lit(0).alias("place"), F.lit(None).cast("string").alias("subject"), *marks)
    for name, (df, by, columns, ascending) in lists.items():
        x = extremes(df, by, columns, ascending, most)
        subject = F.concat_ws("|", *[F.col(c).cast("string") for c in columns if c != by])
        value = F.col(by).cast("double")
        one = {"n": F.lit(1).cast("long"), "low": value, "high": value, "mean": value} | {m: F.lit(None).cast("double") for m in MARKS}
        out = out.unionAll(x.select(F.lit("list"), F.lit(name), "place", subject, *one.values()))
    return out
