"""Summaries of a fleet from its stations' profiles, states and cleaned tables: totals, leaders, completeness, usable rows, examples, presence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from obsmill.operators.cleaning import readable
from obsmill.operators.fleet import first_n, matches
from obsmill.operators.quality import extremes
from obsmill.plans.rules import resolve

#: Columns that tell when and where a row is from; the first five aren't metrics, none of them is a text of its own.
CALENDAR = ("YEAR", "Year", "MonthNum", "Day", "Hour")
PLACES = ("station_id", "STATION", "station_name", "NAME", "DATE", "date", "YEAR", "Year", "year", "MonthNum", "month", "Day", "day", "Hour", "hour")


def fleet_summary(profiles: DataFrame, most: int = 10) -> DataFrame:
    """(section, name, n, rate) of full profiles: stations and rows, the mean of the stations' rates, the identifiers of the highest rates of flags by row, totals of rule families.

    All rows of the fleet are under every identifier's count, so that the highest counts have the highest rates.
    """
    rates = ("fraction_rows_impacted", "fraction_rows_structural_impacted")
    none = F.lit(None)
    whole = profiles.agg(F.count("*").alias("stations"), F.coalesce(F.sum("rows_total"), F.lit(0)).alias("rows"), *[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in rates])
    row = lambda section, name, n, rate: F.struct(F.lit(section).alias("section"), F.lit(name).alias("name"), n.cast("long").alias("n"), rate.cast("double").alias("rate"))
    totals = whole.select(F.inline(F.array(row("total", "stations", F.col("stations"), none), row("total", "rows", F.col("rows"), none), *[row("average", c, none, F.col(c)) for c in rates])))
    counted = lambda m, section: profiles.select(F.explode(m).alias("name", "n")).groupBy("name").agg(F.sum("n").alias("n")).select(F.lit(section).alias("section"), "name", "n", none.cast("double").alias("rate"))
    top = counted("qc_flag_counts_by_identifier", "identifier").orderBy(F.desc("n"), F.desc("name")).limit(most)
    out = totals.unionAll(top).unionAll(counted("rule_family_impact_counts", "family"))
    all_rows = F.max(F.when((F.col("section") == "total") & (F.col("name") == "rows"), F.col("n"))).over(Window.partitionBy())  # over these few rows
    share = F.when(all_rows > 0, F.col("n") / all_rows).otherwise(F.lit(0.0))
    return out.withColumn("rate", F.when(F.col("section") == "identifier", share).otherwise(F.col("rate")))


def completeness(profiles: DataFrame, by: list[str]) -> DataFrame:
    """(*by, field, rows_total, null_count, ratio) of full profiles; one without nulls has the row ``__all__``, which counts its flagged rows."""
    entries = F.transform(F.map_entries("null_counts_by_identifier"), lambda e: F.struct(e["key"].alias("field"), e["value"].alias("null_count")))
    alone = F.array(F.struct(F.lit("__all__").alias("field"), F.col("rows_with_qc_flags").alias("null_count")))
    out = profiles.select(*by, "rows_total", F.inline(F.when(F.size(entries) > 0, entries).otherwise(alone)))
    return out.withColumn("ratio", F.when(F.col("rows_total") > 0, (F.col("rows_total") - F.col("null_count")) / F.col("rows_total")).otherwise(F.lit(0.0)))


def outliers(status: DataFrame, key: str = "station_id", state: str = "status", most: int = 5) -> DataFrame:
    """(list, place, key, input_size_bytes, cleaned_columns): of completed stations those of the largest input and those of the widest cleaned table; what is no number counts as 0."""
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    sizes = ("input_size_bytes", "cleaned_columns")
    done = status.where(F.col(state) == "completed").select(key, *[number(c).alias(c) for c in sizes])
    lists = [extremes(done, c, [key, *sizes], False, most).withColumn("list", F.lit(name)) for name, c in zip(("largest_input_stations", "widest_cleaned_schemas"), sizes, strict=True)]
    return lists[0].unionByName(lists[1])


def impact_leaders(profiles: DataFrame, key: str, years: DataFrame, most: int = 10) -> DataFrame:
    """(section, place, key, year, rate, n, rows_total): the profiles of the highest rates of structural and of all impacts, and of ``years`` those with the most flagged rows."""
    out = []
    for section, df, rate, n in (
        ("structural", profiles, "fraction_rows_structural_impacted", "rows_with_structural_impacts"), ("substantive", profiles, "fraction_rows_impacted", "rows_with_qc_flags"), ("station_years", years, "rows_with_qc_flags", "rows_with_qc_flags"),
    ):
        columns = list(dict.fromkeys([key, *(["year"] if df is years else []), rate, n, "rows_total"]))
        x = extremes(df, rate, columns, False, most)
        year = F.col("year").cast("int") if df is years else F.lit(None).cast("int")
        share = F.col(rate) if rate != n else F.when(F.col("rows_total") > 0, F.col(n) / F.col("rows_total"))
        out.append(x.select(F.lit(section).alias("section"), "place", key, year.alias("year"), share.cast("double").alias("rate"), F.col(n).alias("n"), "rows_total"))
    return reduce(DataFrame.unionAll, out)


def usable_row(df: DataFrame) -> Column:
    """Whether a row has a usable value: by its own mark, else any number or truth value, else, in tables without such, any text that isn't blank."""
    if "row_has_any_usable_metric" in df.columns:
        return F.coalesce(F.col("row_has_any_usable_metric").cast("boolean"), F.lit(False))
    metrics = [f.name for f in df.schema if isinstance(f.dataType, NumericType | BooleanType) and f.name not in CALENDAR]
    there = lambda c: F.col(c).isNotNull() if metrics else F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != ""
    return reduce(lambda a, b: a | b, [there(c) for c in metrics or [c for c in df.columns if c not in PLACES]], F.lit(False))


def usable_rows(domains: dict[str, DataFrame], whole: DataFrame | None, by: str) -> DataFrame:
    """(by, domain, rows_total, usable_rows, usable_row_rate, artifact_mode) of domain tables; stations without any are counted in ``whole`` as ``__all__``."""

    def counted(df: DataFrame, name: str, mode: str) -> DataFrame:
        return df.groupBy(by).agg(F.count("*").alias("rows_total"), F.count_if(usable_row(df)).alias("usable_rows")).withColumns({"domain": F.lit(name), "artifact_mode": F.lit(mode)})

    parts = [counted(df, name, "domain_splits") for name, df in domains.items()]
    if whole is not None:
        rest = counted(whole, "__all__", "fallback_no_domain_splits")
        parts.append(rest.join(reduce(DataFrame.unionAll, [p.select(by) for p in parts]).distinct(), by, "left_anti").select(*parts[0].columns) if parts else rest)
    return reduce(DataFrame.unionAll, parts).withColumn("usable_row_rate", F.col("usable_rows") / F.col("rows_total"))


def sentinel_alignment(df: DataFrame, identifiers: list[str], by: list[str]) -> DataFrame:
    """(*by, field, n_raw, n_replaced, n_null) of a table cleaned with its raw cells kept: missing marks in the cells of each number, and which of them are null.

    A mark is one of the part's sentinels, or two nines or more, pluses before it left out. One pass over df.
    """
    counts, fields = {}, []
    for x in identifiers:
        name_of = {path[1]: name for name, path in readable(x).items() if len(path) == 2}
        for n, part in enumerate(resolve(x), 1):
            field = name_of.get(part.name or f"part{n}")
            if part.kind != "numeric" or field not in df.columns or x not in df.columns:
                continue
            token = F.regexp_replace(F.trim(F.get(F.split(F.col(x), ","), F.lit(n - 1))), r"^\++", "")
            mark = F.coalesce(token.isin(*(part.sentinels or ())) | token.rlike("^9{2,}$") if part.sentinels else token.rlike("^9{2,}$"), F.lit(False))
            counts[field] = F.struct(F.count_if(mark).alias("n_raw"), F.count_if(mark & F.col(field).isNull()).alias("n_replaced"), F.count_if(F.col(field).isNull()).alias("n_null"))
            fields.append(field)
    made = df.groupBy(*by).agg(*[c.alias(f"x{k}") for k, c in enumerate(counts.values())])
    return made.select(*by, F.inline(F.array(*[F.struct(F.lit(f).alias("field"), *[F.col(f"x{k}")[c].alias(c) for c in ("n_raw", "n_replaced", "n_null")]) for k, f in enumerate(fields)])))


def examples(df: DataFrame, file: str, order: str, most: int, fields: tuple[str, ...] = ("TMP", "VIS", "WND", "AA1", "DATE")) -> DataFrame:
    """(pattern, file, order, *fields): of each pattern the first ``most`` rows over files in order, rows equal in ``fields`` once a file."""
    found = matches(df.select(file, order, *fields))
    print_ = F.md5(F.concat_ws("|", *[F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in fields]))
    once = found.groupBy("pattern", file, print_.alias("fingerprint")).agg(F.min_by(F.struct(order, *fields), order).alias("x")).select("pattern", file, "x.*")
    return first_n(once, ["pattern"], [file, order], most)


def first_known(df: DataFrame, by: list[str], order: str, columns: list[str]) -> DataFrame:
    """(*by, *columns): of each column the first value that isn't null, each on its own."""
    return df.groupBy(*by).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])


def sync(state: DataFrame, files: DataFrame, key: str = "file_name") -> DataFrame:
    """(key, path, state) of rows (key, pulled, raw_path, default_path) against the paths of files that are there.

    Pulled files are present at the path of their state, or stale where they lie at the default path but their state
    names another, else missing; others are unexpected where they lie at the default path, else absent.
    """
    there = files.select("path").distinct()
    raw = F.when(F.trim("raw_path") != "", F.trim("raw_path"))
    x = state.select(key, F.coalesce("pulled", F.lit(False)).alias("pulled"), raw.alias("raw"), F.col("default_path").alias("usual"))
    x = x.join(there.select(F.col("path").alias("raw"), F.lit(True).alias("at_raw")), "raw", "left").join(there.select(F.col("path").alias("usual"), F.lit(True).alias("at_usual")), "usual", "left")
    found = F.when(F.col("at_raw"), F.col("raw")).when(F.col("at_usual"), F.col("usual")).otherwise(F.coalesce("raw", "usual"))
    kind = F.when(~F.col("pulled"), F.when(F.col("at_usual"), "unexpected").otherwise("absent")).when(F.col("at_raw"), "present").when(F.col("at_usual"), F.when(F.col("raw").isNull(), "present").otherwise("stale")).otherwise("missing")
    return x.select(key, F.when(F.col("pulled"), found).otherwise(F.col("usual")).alias("path"), kind.alias("state"))


def station_rows(files: DataFrame, metadata: DataFrame, key: str, year: str, first: int, last: int, attributes: tuple[str, ...] = ("LATITUDE", "LONGITUDE", "ELEVATION", "NAME")) -> DataFrame:
    """metadata with its station's distinct years, the first, last and number of files of the years asked for, and whether all attributes are known."""
    asked = F.when(F.col(year).between(first, last), F.col(year))
    spans = files.groupBy(key).agg(F.countDistinct(year).alias("no_of_years"), F.min(asked).alias("first_year"), F.max(asked).alias("last_year"), F.count(asked).alias("year_count"))
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in attributes])
    return metadata.join(spans, key, "left").withColumn("metadata_complete", complete)
