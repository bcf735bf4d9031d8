"""Climatologies: completeness filters, rollups and strategies, always within a station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def circular_mean(direction: Column, weight: Column | None = None) -> Column:
    """Mean direction in degrees, 0 to 360."""
    w = F.when(direction.isNotNull(), F.lit(1.0) if weight is None else weight)
    s, c = F.sum(w * F.sin(F.radians(direction))), F.sum(w * F.cos(F.radians(direction)))
    return F.when(F.sum(w) > 0, F.pmod(F.degrees(F.atan2(s, c)) + 360, F.lit(360.0)))


def times(df: DataFrame, date: str = "DATE") -> DataFrame:
    d = F.col(date)
    return df.where(d.isNotNull()).withColumns({"year": F.year(d), "month": F.month(d), "day": F.to_date(d), "hour": F.hour(d)})


def text_times(df: DataFrame) -> DataFrame:
    """df with DATE as a timestamp, and year, month, day and hour; rows without a date go.

    DATE is an ISO date or eight digits. One at midnight takes the clock time of TIME (HHMM) where that is valid.
    DATE_PARSED, where present, stands in for a DATE that can't be read, and is dropped.
    """

    def read(text: Column) -> Column:
        at = F.coalesce(F.try_to_timestamp(text), F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd"))))
        if "TIME" not in df.columns:
            return at
        clock = F.col("TIME").cast("string")
        minutes = F.substring(clock, 1, 2).try_cast("int") * 60 + F.substring(clock, 3, 2).try_cast("int")
        valid = clock.rlike(r"^([01]\d|2[0-3])[0-5]\d$") & (F.date_trunc("day", at) == at)
        return F.when(valid, F.timestamp_add("MINUTE", F.when(valid, minutes), at)).otherwise(at)

    date = F.when(F.col("DATE").cast("string").rlike(r"^\d{8}$"), F.lit(None).cast("string")).otherwise(F.col("DATE").cast("string"))
    eight = F.when(F.col("DATE").cast("string").rlike(r"^\d{8}$"), F.col("DATE").cast("string"))
    at = F.coalesce(read(date), read(eight))
    if "DATE_PARSED" in df.columns:
        at = F.coalesce(at, read(F.col("DATE_PARSED").cast("string")))
    return times(df.withColumn("DATE", at).drop("DATE_PARSED"))


def rollup(df: DataFrame, by: list[str], how: dict[str, str]) -> DataFrame:
    """One row a group; each metric by its own function."""
    made = {
        "mean": F.avg, "max": F.max, "min": F.min, "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
        "mode": lambda c: F.mode(F.col(c), True), "circular_mean": lambda c: circular_mean(F.col(c)),
    }
    return df.groupBy(*by).agg(*[made[f](c).alias(c) for c, f in how.items() if f != "drop"])


def weighted_rollup(df: DataFrame, by: list[str], how: dict[str, str], weight: str, skip_nulls: bool = False) -> DataFrame:
    """Weighted means (extremes and sums as they are); the weights of null values count unless skip_nulls."""

    def one(c: str, f: str) -> Column:
        if f in ("max", "min"):
            return getattr(F, f)(c)
        if f == "sum":
            return F.coalesce(F.sum(c), F.lit(0.0))
        if f == "circular_mean":
            return circular_mean(F.col(c), F.col(weight))
        total = F.sum(F.when(F.col(c).isNotNull(), F.col(weight))) if skip_nulls else F.sum(weight)
        return F.sum(F.col(c) * F.col(weight)) / total

    return df.groupBy(*by).agg(*[one(c, f).alias(c) for c, f in how.items() if f != "drop"])


def daily_triples(df: DataFrame, by: list[str], how: dict[str, str]) -> DataFrame:
    made = []
    for c, f in how.items():
        if f == "circular_mean":
            made.append(circular_mean(F.col(c)).alias(f"{c}__daily_mean"))
        elif f != "drop":
            made += [F.min(c).alias(f"{c}__daily_min"), F.max(c).alias(f"{c}__daily_max"), F.avg(c).alias(f"{c}__daily_mean")]
    return df.groupBy(*by).agg(*made)


def full_months(df: DataFrame, least_days: int = 20, station: str = "STATION") -> DataFrame:
    keys = df.groupBy(station, "year", "month").agg(F.countDistinct("day").alias("days")).where(F.col("days") >= least_days)
    return df.join(keys.drop("days"), [station, "year", "month"], "left_semi")


def full_years(df: DataFrame, least_months: int = 12, station: str = "STATION") -> DataFrame:
    keys = df.groupBy(station, "year").agg(F.countDistinct("month").alias("months")).where(F.col("months") >= least_months)
    return df.join(keys.drop("months"), [station, "year"], "left_semi")


def hour_weights(df: DataFrame, least_hours: int = 18, station: str = "STATION") -> DataFrame:
    """df with the number of distinct hours of its day; days with fewer than least_hours go."""
    hours = df.groupBy(station, "day").agg(F.countDistinct("hour").alias("hours")).where(F.col("hours") >= least_hours)
    return df.join(hours, [station, "day"])


def best_hours(df: DataFrame, station: str = "STATION") -> DataFrame:
    """(station, hour): the hour that most days have, the earliest on ties."""
    days = df.groupBy(station, "hour").agg(F.countDistinct("day").alias("days"))
    return days.groupBy(station).agg(F.max_by("hour", F.struct("days", -F.col("hour"))).alias("hour"))


def whole_months(days: DataFrame, least_days: int, least_months: int, station: str, *more: str) -> DataFrame:
    """(station, year, month, *more) of months with enough days in years with enough such months, from distinct days (and *more, one value a station)."""
    keys = [station, "year", "month", *more]
    months = days.groupBy(*keys).agg(F.countDistinct("day").alias("_days")).where(F.col("_days") >= least_days)
    number = F.count("month").over(Window.partitionBy(station, "year"))  # of twelve rows or fewer
    return months.withColumn("_months", number).where(F.col("_months") >= least_months).select(*keys)


def climatology(df: DataFrame, strategy: str, how: dict[str, str], hour: int | None = None, least_days: int = 20, least_months: int = 12, least_hours: int = 18, station: str = "STATION") -> dict[str, DataFrame]:
    """hourly, monthly and yearly frames of timed rows by one of the five strategies.

    Which rows count is found from the distinct days and hours of df, which are few; df itself is joined with them once.
    """
    keys = [station, "year", "month"]
    days = df.select(*keys, "day").distinct()
    slots = df.select(*keys, "day", "hour").distinct()
    if strategy == "best_hour":
        chosen = slots.join(best_hours(slots, station), [station, "hour"])
        rows = df.join(whole_months(chosen, least_days, least_months, station, "hour"), [*keys, "hour"], "left_semi")
    elif strategy == "fixed_hour":
        if hour is None:
            raise ValueError("fixed_hour needs an hour")
        rows = df.where(F.col("hour") == hour).join(whole_months(slots.where(F.col("hour") == hour), least_days, least_months, station), keys, "left_semi")
    elif strategy == "weighted_hours":
        weights = slots.groupBy(*keys, "day").agg(F.count("hour").alias("hours")).where(F.col("hours") >= least_hours)
        weights = weights.join(whole_months(weights, least_days, least_months, station), keys, "left_semi")
        rows = df.join(weights, [*keys, "day"])
        return {"hourly": rows, "monthly": weighted_rollup(rows, keys, how, "hours"), "yearly": weighted_rollup(rows, [station, "year"], how, "hours")}
    else:
        rows = df.join(whole_months(days, least_days, least_months, station), keys, "left_semi")
    if strategy in ("best_hour", "fixed_hour"):
        return {"hourly": rows, "monthly": rollup(rows, keys, how), "yearly": rollup(rows, [station, "year"], how)}
    if strategy == "hour_day_month_year":
        hourly = rollup(rows, [*keys, "day", "hour"], how)
        daily = rollup(hourly, [*keys, "day"], how)
        return {"hourly": hourly, "daily": daily, "monthly": rollup(daily, keys, how), "yearly": rollup(daily, [station, "year"], how)}
    if strategy == "daily_min_max_mean":
        daily = daily_triples(rows, [*keys, "day"], how)
        means = {c: "mean" for c in daily.columns if "__daily_" in c}
        return {"daily": daily, "monthly": rollup(daily, keys, means), "yearly": rollup(daily, [station, "year"], means)}
    raise ValueError(f"no strategy {strategy}")
