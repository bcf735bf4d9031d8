"""Cleaning of whole observation tables: control fields, coded cells, readable names, usability, and views of themes."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from obsmill.functions import decode as d
from obsmill.functions import records
from obsmill.functions.identifiers import class_of
from obsmill.operators.climate import text_times
from obsmill.plans.rules import REPEATS, TABLES, resolve

#: Control fields, their columns' positions in a record and the errors of a header.
HEADER = {"total": (1, 4), "usaf": (5, 6), "wban": (11, 5), "date": (16, 8), "time": (24, 4), "source": (28, 1), "latitude": (29, 6), "longitude": (35, 7), "elevation": (42, 5), "report_type": (47, 5), "call_sign": (52, 5), "qc_process": (57, 4)}
SHORT, WIDTH, SENTINEL, DOMAIN = "control_header_short", "control_header_invalid_width", "control_header_invalid_sentinel", "control_header_invalid_domain"
CONTROL = ("LATITUDE", "LONGITUDE", "DATE", "TIME", "ELEVATION", "CALL_SIGN", "SOURCE", "REPORT_TYPE", "QUALITY_CONTROL")
#: Thematic views, their columns after the keys.
KEYS = ("station_id", "DATE")
VIEWS = {
    "metadata": ("YEAR", "LATITUDE", "LONGITUDE", "ELEVATION", "REPORT_TYPE", "CALL_SIGN"),
    "wind": ("wind_speed_ms", "wind_direction_deg", "wind_gust_ms", "wind_type_code", "WND__part4__qc_pass"),
    "precipitation": ("precip_amount_1", "precip_period_hours_1", "snow_accum_depth_cm_1", "AA1__part2__qc_pass"),
    "clouds_visibility": ("visibility_m", "ceiling_height_m", "cloud_total_coverage", "VIS__part1__qc_pass", "CIG__part1__qc_pass"),
    "pressure_temperature": ("temperature_c", "dew_point_c", "station_pressure_hpa", "sea_level_pressure_hpa", "altimeter_setting_hpa", "TMP__qc_pass", "SLP__qc_pass"),
    "remarks": ("remarks_text",),
}
#: Columns of the cleaned table that have fixed types.
CONTRACT = {"STATION": "string", "DATE": "string", "YEAR": "int", "row_has_any_usable_metric": "boolean", "usable_metric_count": "int", "usable_metric_fraction": "double"}


def calendar_day(text: Column) -> Column:
    """Whether eight digits are a day of the calendar, the year 0000 included."""
    year, month, day = (F.substring(text, *x).try_cast("int") for x in ((1, 4), (5, 2), (7, 2)))
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    last = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    return text.rlike(r"^\d{8}$") & F.coalesce(month.between(1, 12) & (day >= 1) & (day <= last), F.lit(False))


def clock_time(text: Column) -> Column:
    return text.rlike(r"^([01]\d|2[0-3])[0-5]\d$")


def header_error(line: Column) -> Column:
    """The first fault of a record's control header (its first 60 characters), or null."""
    text = F.regexp_replace(line, r"[\r\n]+$", "")
    at = {k: F.substring(text, *v) for k, v in HEADER.items()}
    nines = lambda c: F.translate(c, "+-", "").rlike("^9+$")
    error = F.when(F.length(text) < 60, SHORT)
    digits = ~at["total"].rlike(r"^\d{4}$") | ~at["wban"].rlike(r"^\d{5}$") | ~at["date"].rlike(r"^\d{8}$") | ~at["time"].rlike(r"^\d{4}$")
    error = error.when(digits, WIDTH)
    places = {"latitude": (5, "+99999"), "longitude": (6, "+999999"), "elevation": (4, "+9999")}
    for k, (n, missing) in places.items():
        error = error.when(~at[k].rlike(rf"^[+-]\d{{{n}}}$"), F.when(nines(at[k]) & (at[k] != missing), SENTINEL).otherwise(WIDTH))
    for k, (_, missing) in places.items():
        error = error.when(nines(at[k]) & (at[k] != missing), SENTINEL)
    within = lambda k, low, high: (at[k] == places[k][1]) | at[k].try_cast("int").between(low, high)
    sound = (
        at["source"].isin(*TABLES["source_flag"]) & ((at["report_type"] == "99999") | at["report_type"].isin(*TABLES["report_type"])) & at["call_sign"].rlike(r"^[\x00-\x7F]*$")
        & ((at["qc_process"] == "9999") | at["qc_process"].isin("V01 ", "V02 ", "V03 ")) & calendar_day(at["date"]) & clock_time(at["time"])
        & within("latitude", -90000, 90000) & within("longitude", -179999, 180000) & within("elevation", -400, 8850)
    )
    return error.when(~sound, DOMAIN)


def record_error(line: Column) -> Column:
    """A record's fault: its header's before its structure's."""
    return F.coalesce(header_error(line), records.structure_error(line))


def _place(text: Column, width: int, scale: float, low: float, high: float, missing: str) -> Column:
    """A fixed-width integer (with or without sign) over scale, or a decimal, within bounds."""
    bare = F.regexp_replace(text, "^[+-]", "")
    fixed = text.rlike(r"^[+-]?\d+$") & (F.length(bare) == F.when(text.rlike("^[+-]"), width - 1).otherwise(width))
    value = F.when(text == missing, None).when(fixed, text.try_cast("double") / scale).when(text.contains("."), d.number(text))
    return F.when(value.between(low, high), value)


def normal_control(df: DataFrame) -> dict[str, Column]:
    """The control fields of df in normal form; what isn't valid is null. LATITUDE and the like become degrees and metres."""
    text = lambda c: F.when(~F.trim(F.col(c).cast("string")).isin("", "nan", "None"), F.trim(F.col(c).cast("string")))
    upper = lambda c: F.upper(text(c))
    sign = F.col("CALL_SIGN").cast("string") if "CALL_SIGN" in df.columns else None
    made = {
        "LATITUDE": lambda: _place(text("LATITUDE"), 6, 1000.0, -90.0, 90.0, "99999"),
        "LONGITUDE": lambda: _place(text("LONGITUDE"), 7, 1000.0, -179.999, 180.0, "999999"),
        "ELEVATION": lambda: _place(text("ELEVATION"), 5, 1.0, -400.0, 8850.0, "9999"),
        "DATE": lambda: F.when(calendar_day(text("DATE")), text("DATE")),
        "TIME": lambda: F.when(clock_time(text("TIME")), text("TIME")),
        "CALL_SIGN": lambda: F.when(sign.rlike(r"^[\x20-\x7E]{5}$") & (sign != "99999") & (F.rtrim(sign) != ""), F.rtrim(sign)),
        "SOURCE": lambda: F.when(upper("SOURCE").isin(*TABLES["source_flag"]) & (upper("SOURCE") != "9"), upper("SOURCE")),
        "REPORT_TYPE": lambda: F.when((F.length(upper("REPORT_TYPE")) == 5) & upper("REPORT_TYPE").isin(*TABLES["report_type"]), upper("REPORT_TYPE")),
        "QUALITY_CONTROL": lambda: F.when(upper("QUALITY_CONTROL").isin(*TABLES["qc_process"]), upper("QUALITY_CONTROL")),
    }
    return {c: f() for c, f in made.items() if c in df.columns}


def control_flags(df: DataFrame) -> DataFrame:
    """df with qc_control_invalid_<field> for its control fields, and qc_domain_invalid_CONTROL where one of them holds."""
    normal = normal_control(df)
    if not normal:
        return df
    flags = {f"qc_control_invalid_{c.lower()}": F.col(c).isNotNull() & normal[c].isNull() for c in CONTROL if c in normal}
    return df.withColumns(flags).withColumn("qc_domain_invalid_CONTROL", reduce(lambda a, b: a | b, map(F.col, flags)))


def drop_marker(df: DataFrame, marker: str = "ADD") -> DataFrame:
    """df without the marker column, if it holds nothing but its own name."""
    if marker not in df.columns:
        return df
    other = df.where(F.col(marker).isNotNull() & (F.trim(marker) != "") & (F.upper(F.trim(marker)) != marker)).limit(1)
    return df.drop(marker) if other.isEmpty() else df


def readable(identifier: str) -> dict[str, tuple[str, ...]]:
    """For each output column of a family the path of its field in the decoded struct."""
    parts, base = resolve(identifier), f"{identifier.lower()}_"
    suffix = f"_{identifier[2]}" if identifier[:2] in REPEATS else ""
    lone = len(parts) == 1 and parts[0].quality is not None
    out: dict[str, tuple[str, ...]] = {}
    for n, part in enumerate(parts, 1):
        field = f"q{n}" if part.kind == "quality" else part.name or f"part{n}"
        stem = identifier if lone else f"{identifier}__part{n}"
        out[f"{part.name}{suffix}" if part.name else stem] = (base, field)
        if lone:
            out[f"{identifier}__quality"] = (base, "quality")
        if part.kind == "numeric":
            out |= {f"{stem}__qc_{k}": (base, f"{field}_qc", k) for k in ("pass", "status", "reason")}
    flags = {"WND": {"WND__direction_variable": "direction_variable", "qc_calm_wind_detected": "calm"}}.get(identifier, {})
    if identifier[:2] in ("AC", "AD", "AG", "AH"):
        flags = {f"qc_domain_invalid_{identifier}": "domain_invalid", f"qc_pattern_mismatch_{identifier}": "pattern_mismatch"}
    if identifier[:2] == "AH":
        flags[f"qc_arity_mismatch_{identifier}"] = "arity_mismatch"
    if identifier[:2] == "OD":
        flags[f"qc_calm_direction_detected_{identifier}"] = "calm_direction"
    if identifier[:2] == "OE":
        flags[f"qc_calm_speed_detected_{identifier}"] = "calm_speed"
    return out | {k: (base, v) for k, v in flags.items()}


def flattened(df: DataFrame, identifiers: list[str], keep: list[str]) -> DataFrame:
    """The columns to keep and those of the decoded families under readable names; equal names are an error that lists them."""
    made = [(name, path) for x in identifiers for name, path in readable(x).items()]
    twice = sorted(k for k, n in Counter([*keep, *(name for name, _ in made)]).items() if n > 1)
    if twice:
        raise ValueError(f"columns would have equal names: {', '.join(twice)}")
    return df.selectExpr(*[f"`{c}`" for c in keep], *[f"{'.'.join(f'`{k}`' for k in path)} as `{name}`" for name, path in made])


def with_usability(df: DataFrame, fixed_count: int | None = None) -> DataFrame:
    """df with whether a row has any usable metric, how many and which fraction of its verdict columns (or of ``fixed_count``)."""
    passes = [c for c in df.columns if c.endswith("__qc_pass")]
    n = F.expr(" + ".join(["0", *[f"cast(coalesce(`{c}`, false) as int)" for c in passes]]))
    share = n / F.lit(fixed_count or len(passes)) if passes else F.lit(0.0)
    return df.withColumns({"row_has_any_usable_metric": n > 0, "usable_metric_count": n, "usable_metric_fraction": share.cast("double")})


def clean(df: DataFrame, strict: bool = True, keep_raw: bool = False, fixed_count: int | None = None) -> DataFrame:
    """A raw table cleaned: every coded column decoded under readable names, control flags, usability of rows.

    Which columns are coded is decided by their names alone. With raw_line, faulty records keep their row, have
    __parse_error and null values. The fraction of usable metrics is over the verdict columns of the table, or
    over ``fixed_count``. Empty tables and tables without coded columns give the same columns and no metrics.
    """
    df = drop_marker(df)
    coded = [c for c in df.columns if resolve(c) is not None]
    if "raw_line" in df.columns:
        df = df.withColumn("__parse_error", record_error(F.col("raw_line")))
        df = df.withColumns({c: F.when(F.col("__parse_error").isNull(), F.col(c)) for c in coded})
    df = control_flags(df)
    keep = [c for c in df.columns if keep_raw or c not in coded]
    if coded:
        df = flattened(d.decode_all(df, coded, strict), coded, keep)
    return with_usability(df, fixed_count)


def clean_or_permit(df: DataFrame, probe: int = 10) -> tuple[DataFrame, bool]:
    """The cleaned table and whether it was cleaned strictly: not where one of the first dates is an ISO one (with T or -),
    nor where no row would be left, as none has a date that can be read.
    """
    strict = df.where(F.col("DATE").isNotNull()).limit(probe).where(F.col("DATE").cast("string").rlike("[T-]")).isEmpty()
    if strict and not df.isEmpty():
        strict = not text_times(df.select(*[c for c in ("DATE", "TIME") if c in df.columns])).isEmpty()
    return clean(df, strict=strict), strict


def strict_losses(df: DataFrame, identifiers: list[str]) -> DataFrame:
    """(field, n_permissive, newly_null, rate): values that permissive decoding gives and strict decoding doesn't, in one pass over df."""
    loose = {f"{x.lower()}_": f"{x.lower()}_permissive" for x in identifiers}
    both = d.decode_all(d.decode_all(df.select(*identifiers), identifiers, strict=False).withColumnsRenamed(loose), identifiers)
    fields = {name: path for x in identifiers for name, path in readable(x).items() if len(path) == 2 and not name.startswith("qc_") and not name.endswith(("__quality", "__direction_variable"))}
    there = {name: F.col(loose[base])[field].isNotNull() for name, (base, field) in fields.items()}
    counts = both.agg(*[F.struct(F.count_if(there[n]).alias("n_permissive"), F.count_if(there[n] & F.col(base)[field].isNull()).alias("newly_null")).alias(n) for n, (base, field) in fields.items()])
    long = counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n)["n_permissive"].alias("n_permissive"), F.col(n)["newly_null"].alias("newly_null")) for n in fields])))
    return long.withColumn("rate", F.when(F.col("n_permissive") > 0, F.col("newly_null") / F.col("n_permissive")).otherwise(F.lit(0.0)))


def with_contract(df: DataFrame) -> DataFrame:
    """df with station_id and YEAR."""
    text = F.col("DATE").cast("string")
    return df.withColumns({"station_id": F.col("STATION"), "YEAR": F.year(F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit("yyyyMMdd"))))})


def contract_faults(df: DataFrame, contract: dict[str, str] = CONTRACT) -> DataFrame:
    """(column, fault, n): required columns that lack, and how many values don't fit their column's type."""
    spark = df.sparkSession
    lacking = [(c, "missing", None) for c in contract if c not in df.columns]
    there = {c: t for c, t in contract.items() if c in df.columns}
    wrong = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast(t).isNull()).alias(c) for c, t in there.items()])
    long = wrong.unpivot([], list(there), "column", "n").where("n > 0").select("column", F.lit("type").alias("fault"), "n")
    return long.unionByName(spark.createDataFrame(lacking, "column string, fault string, n long"))


def view(df: DataFrame, name: str) -> DataFrame | None:
    """The keys and a theme's columns that df has; None if it has none of the theme's."""
    there = [c for c in VIEWS[name] if c in df.columns]
    return df.select(*[c for c in KEYS if c in df.columns], *there) if there else None


#: Fixed value: the version of the views' columns.
VIEW_VERSION = "1"


def _written(df: DataFrame, path: str, keys: list[str], partitions: list[str]) -> int:
    """Rows written as Parquet in the order of keys; they are counted as they pass."""
    counted = Observation()
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
    ordered.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy(*partitions).parquet(path)
    return counted.get["n"]


def write_views(df: DataFrame, folder: str) -> DataFrame:
    """Each theme's view as Parquet by station in the order of the keys, and the manifest: (domain, n_rows, columns, path, schema_version)."""
    rows = []
    for name in VIEWS:
        made = view(df, name)
        if made is None:
            continue
        path = f"{folder}/{name}"
        rows.append((name, _written(made, path, [c for c in KEYS if c in made.columns], ["station_id"]), made.columns, path, VIEW_VERSION))
    return df.sparkSession.createDataFrame(rows, "domain string, n_rows long, columns array<string>, path string, schema_version string")


def write_classes(df: DataFrame, folder: str) -> DataFrame:
    """Each class's table as Parquet, and the manifest: (class, n_rows, columns, path)."""
    rows = []
    for name, made in split_by_class(df).items():
        path = f"{folder}/{name}"
        rows.append((name, _written(made, path, [c for c in ("station_id", "STATION", "DATE") if c in made.columns], []), made.columns, path))
    return df.sparkSession.createDataFrame(rows, "class string, n_rows long, columns array<string>, path string")


def split_by_class(df: DataFrame) -> dict[str, DataFrame]:
    """Nine tables by class of metric columns, each with the common ones."""
    classes: dict[str, list[str]] = {}
    for c in df.columns:
        classes.setdefault(class_of(c), []).append(c)
    common = classes.pop("common", [])
    return {k: df.select(*common, *v) for k, v in classes.items()}


def class_report(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """(*by, domain, n_rows, n_any, fraction_any, n_null, null_fraction) over the metric columns of each class."""
    classes: dict[str, list[str]] = {}
    for c in columns:
        classes.setdefault(class_of(c), []).append(c)
    some = {k: reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in v]) for k, v in classes.items()}
    nulls = {k: sum((F.col(c).isNull().cast("long") for c in v), F.lit(0)) for k, v in classes.items()}
    agg = df.groupBy(*by).agg(F.count("*").alias("n_rows"), *[F.struct(F.count_if(some[k]).alias("n_any"), F.sum(nulls[k]).alias("n_null"), F.lit(len(classes[k])).alias("width")).alias(k) for k in classes])
    long = agg.select(*by, "n_rows", F.explode(F.array(*[F.struct(F.lit(k).alias("domain"), F.col(k).alias("x")) for k in classes])).alias("e"))
    return long.select(*by, "n_rows", "e.domain", "e.x.n_any", (F.col("e.x.n_any") / F.col("n_rows")).alias("fraction_any"), "e.x.n_null", (F.col("e.x.n_null") / (F.col("n_rows") * F.col("e.x.width"))).alias("null_fraction"))


def profile(df: DataFrame, by: list[str], compat: bool = True) -> DataFrame:
    """Rows of a cleaned table that each cause touches, by group.

    With ``compat`` every flag counts as a cause of its own, also calm wind and the control flag that holds for
    all ISO dates; without it these two don't.
    """
    reasons = {c: c.split("__")[0] for c in df.columns if c.endswith("__qc_reason")}
    flags = [c for c in df.columns if c.startswith("qc_") and (compat or not c.startswith("qc_calm") and c != "qc_domain_invalid_CONTROL" and not c.startswith("qc_control"))]
    any_of = lambda conditions: reduce(lambda a, b: a | b, conditions, F.lit(False))
    is_ = lambda c, *r: F.coalesce(F.col(c).isin(*r), F.lit(False))
    structural = F.col("__parse_error").isNotNull() if "__parse_error" in df.columns else F.lit(False)
    rows = df.select(
        *by, structural.alias("structural"), any_of([is_(c, "SENTINEL_MISSING") for c in reasons]).alias("sentinel"), any_of([is_(c, "BAD_QUALITY_CODE") for c in reasons]).alias("quality_code"),
        any_of([is_(c, "OUT_OF_RANGE", "MALFORMED_TOKEN") for c in reasons] + [F.coalesce(F.col(c), F.lit(False)) for c in flags]).alias("other"))
    return rows.groupBy(*by).agg(
        F.count("*").alias("rows_total"), F.count_if(F.col("sentinel") | F.col("quality_code") | F.col("other")).alias("rows_with_qc_flags"), F.count_if("structural").alias("rows_with_structural_impacts"),
        F.count_if("sentinel").alias("rows_with_sentinel_impacts"), F.count_if("quality_code").alias("rows_with_quality_code_impacts"), F.count_if("other").alias("rows_with_other_substantive_impacts"),
    ).withColumn("fraction_rows_impacted", F.col("rows_with_qc_flags") / F.col("rows_total"))


#: The rule family of each reason.
FAMILY_OF = {"SENTINEL_MISSING": "sentinel_handling", "BAD_QUALITY_CODE": "quality_code_handling", "OUT_OF_RANGE": "range_validation", "MALFORMED_TOKEN": "width_validation"}


def trigger_counts(df: DataFrame) -> DataFrame:
    """(identifier, family, n) of the verdicts of a cleaned table."""
    reasons = {c: c.split("__")[0] for c in df.columns if c.endswith("__qc_reason")}
    pairs = F.array(*[F.struct(F.lit(x).alias("identifier"), F.col(c).alias("reason")) for c, x in reasons.items()])
    family = reduce(lambda c, x: c.when(F.col("reason") == x[0], x[1]), list(FAMILY_OF.items())[1:], F.when(F.col("reason") == "SENTINEL_MISSING", FAMILY_OF["SENTINEL_MISSING"]))
    long = df.select(F.explode(pairs).alias("x")).select("x.*").where("reason is not null")
    return long.groupBy("identifier", family.alias("family")).agg(F.count("*").alias("n"))


def flag_counts(df: DataFrame) -> DataFrame:
    """(flag, n) of the boolean flags of a cleaned table."""
    flags = [c for c in df.columns if c.startswith("qc_")]
    return df.agg(*[F.count_if(F.col(c)).alias(c) for c in flags]).unpivot([], flags, "flag", "n")
