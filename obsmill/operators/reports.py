"""Reports on raw and cleaned rows: coverage, missing values, retention, impact, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coverage(df: DataFrame, date: str, by: list[str], cleaned: Column) -> DataFrame:
    """Distinct hours, days and months of all rows and of the cleaned ones, and the fraction of hours kept.

    Rows become hours, hours days and days months, so that no row is counted once for each of the units.
    """
    at = F.date_trunc("HOUR", F.col(date))
    out = df.groupBy(*by, at.alias("_at")).agg(F.bool_or(F.coalesce(cleaned, F.lit(False))).alias("_kept"))
    known = F.col("_at").isNotNull()
    counts = {"raw_hours": F.count_if(known), "clean_hours": F.count_if(known & F.col("_kept"))}
    for name, unit in (("days", "DAY"), ("months", "MONTH"), (None, None)):
        keys = [F.date_trunc(unit, "_at").alias("_at")] if unit else []
        out = out.groupBy(*by, *keys).agg(*[c.alias(n) for n, c in counts.items()], F.bool_or("_kept").alias("_kept"))
        counts = {n: F.sum(n) for n in counts} | {f"raw_{name}": F.count_if(known), f"clean_{name}": F.count_if(known & F.col("_kept"))}
    return out.drop("_kept").withColumn("retained", F.when(F.col("raw_hours") > 0, F.col("clean_hours") / F.col("raw_hours")))


def missingness(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, n_missing, n_rows, percent): one pass over df."""
    counts = df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    out = counts.unpivot("n_rows", columns, "field", "n_missing")
    return out.withColumn("percent", F.when(F.col("n_rows") > 0, 100 * F.col("n_missing") / F.col("n_rows")))


def arity(df: DataFrame, parts: dict[str, int]) -> DataFrame:
    """(field, present, mismatched): cells whose token count isn't that of their rule."""
    both = [F.struct(F.lit(c).alias("field"), F.col(c).isNotNull().alias("here"), (F.size(F.split(c, ",", -1)) != n).alias("wrong")) for c, n in parts.items()]
    cells = df.select(F.inline(F.array(*both)))
    return cells.groupBy("field").agg(F.count_if("here").alias("present"), F.count_if(F.col("here") & F.col("wrong")).alias("mismatched"))


def impact(df: DataFrame, reason: str) -> DataFrame:
    """(reason, n, share of rows, share of impacts); rows without a reason count only as rows."""
    counts = df.groupBy(reason).agg(F.count("*").alias("n"))
    # one row a reason from here on, which are few
    all_rows, hit = F.sum("n").over(Window.partitionBy()), F.sum(F.when(F.col(reason).isNotNull(), F.col("n"))).over(Window.partitionBy())
    return counts.select(reason, "n", (F.col("n") / all_rows).alias("row_share"), (F.col("n") / hit).alias("impact_share")).where(F.col(reason).isNotNull())


def merge_profiles(partial: DataFrame, by: list[str], counts: list[str], ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """Additive counts of partial profiles are summed, ratios made again from the sums."""
    out = partial.groupBy(*by).agg(*[F.sum(c).alias(c) for c in counts])
    return out.withColumns({name: F.when(F.col(b) > 0, F.col(a) / F.col(b)) for name, (a, b) in ratios.items()})


def manifest(df: DataFrame, artifact: str, columns: list[str]) -> DataFrame:
    """(artifact, n_rows, checksum): a checksum of the rows whatever their order, summed without overflow."""
    row = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])), 1, 8), 16, 10).cast("decimal(38,0)")
    return df.groupBy(artifact).agg(F.count("*").alias("n_rows"), F.sum(row).cast("string").alias("checksum"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def sizes(df: DataFrame, size: str) -> DataFrame:
    """Mean, median, mode, extremes, quartiles and total; exact percentiles over counts of equal sizes."""
    counts = df.groupBy(size).agg(F.count("*").alias("_n"))
    at = lambda q: F.percentile(size, F.lit(q), F.col("_n"))
    return counts.agg(
        (F.sum(F.col(size) * F.col("_n")) / F.sum("_n")).alias("mean"), at(0.5).alias("median"), F.max_by(size, F.struct("_n", -F.col(size))).alias("mode"), F.min(size).alias("low"), F.max(size).alias("high"),
        at(0.25).alias("p25"), at(0.75).alias("p75"), F.sum(F.col(size) * F.col("_n")).alias("total"),
    )


def domain_usability(df: DataFrame, domains: dict[str, list[str]], by: list[str]) -> DataFrame:
    """(by, domain, n_rows, n_usable, usable_rate): a row is usable in a domain if any of its values is there."""
    both = [F.struct(F.lit(name).alias("domain"), F.greatest(F.lit(False), *[F.col(c).isNotNull() for c in values]).alias("ok")) for name, values in domains.items()]
    rows = df.select(*by, F.inline(F.array(*both)))
    out = rows.groupBy(*by, "domain").agg(F.count("*").alias("n_rows"), F.count_if("ok").alias("n_usable"))
    return out.withColumn("usable_rate", F.col("n_usable") / F.col("n_rows"))
