"""Work on many stations: pull state, inventory, manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_pull_state(old: DataFrame, new: DataFrame, key: str = "station_id") -> DataFrame:
    """One row a station of either table: a station is pulled if either says so; old values win where present."""
    return old.alias("o").join(new.alias("n"), key, "full_outer").select(key, (F.coalesce("o.pulled", F.lit(False)) | F.coalesce("n.pulled", F.lit(False))).alias("pulled"), F.coalesce("o.raw_path", "n.raw_path").alias("raw_path"))


def pending(registry: DataFrame, state: DataFrame, key: str = "station_id") -> DataFrame:
    return registry.join(state.where("pulled").select(key), key, "left_anti")


def keep_first(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_n = 1").drop("_n")


def first_n(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group; Spark cuts groups to n before they are shuffled."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def inventory(df: DataFrame, size: str, key: str, group: list[str] | None = None) -> DataFrame:
    """Rank by size, percentile, and quartile floor(4 i / n) + 1, within group."""
    w = Window.partitionBy(*(group or []))
    ranked = df.withColumns({"rank": F.row_number().over(w.orderBy(size, key)), "_n": F.count("*").over(w)})
    return ranked.withColumns({"percentile": F.when(F.col("_n") > 1, (F.col("rank") - 1) / (F.col("_n") - 1)).otherwise(F.lit(1.0)), "quartile": F.floor((F.col("rank") - 1) * 4 / F.col("_n")).cast("int") + 1}).drop("_n")


def checksum_conflicts(a: DataFrame, b: DataFrame, path: str = "path") -> DataFrame:
    return a.alias("a").join(b.alias("b"), path).where("a.checksum <> b.checksum").select(path, F.col("a.checksum").alias("left_checksum"), F.col("b.checksum").alias("right_checksum"))


def presence(expected: DataFrame, found: DataFrame, key: str = "path") -> DataFrame:
    """Each path with missing, unexpected or present."""
    e, f = expected.select(key, F.lit(True).alias("e")), found.select(key, F.lit(True).alias("f"))
    return e.join(f, key, "full_outer").select(key, F.when(F.col("f").isNull(), "missing").when(F.col("e").isNull(), "unexpected").otherwise("present").alias("state"))


def upsert(state: DataFrame, news: DataFrame, key: str, latest: str) -> DataFrame:
    """One row a key: that of news where there is one, else that of state; of several the latest."""
    both = state.withColumn("_new", F.lit(0)).unionByName(news.withColumn("_new", F.lit(1)))
    fields = [c for c in state.columns if c != key]
    best = both.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct("_new", latest)).alias("_x"))
    return best.select(key, "_x.*").select(*state.columns)


def unresolved(manifest: DataFrame, artifact: str, upstream: str) -> DataFrame:
    """(artifact, reference): references of a JSON list that no row of the manifest has as its id."""
    refs = manifest.select(artifact, F.explode(F.from_json(upstream, "array<string>")).alias("reference"))
    known = manifest.select(F.col(artifact).alias("reference")).distinct()
    return refs.join(known, "reference", "left_anti").select(artifact, "reference")


def station_id(file_name: Column, station: Column) -> Column:
    """The eleven-character id of a station: from its file's name (USAF-WBAN, a year after them left out), else from its id."""
    name = F.regexp_replace(F.regexp_replace(F.trim(file_name), "^.*/", ""), "(?i)[.]csv$", "")
    name = F.replace(F.regexp_replace(name, r"^(.+)-\d{4}$", "$1"), F.lit("-"), F.lit(""))
    plain = F.regexp_replace(F.trim(station), "[.]0$", "")
    number = F.when(plain.rlike("^[0-9]+$") & (F.length(plain) < 11), F.lpad(plain, 11, "0")).otherwise(plain)
    return F.when(F.coalesce(name, F.lit("")) != "", name).otherwise(number)


def truthy(flag: Column) -> Column:
    return F.coalesce(F.lower(F.trim(flag.cast("string"))).isin("true", "1", "yes", "y", "t"), F.lit(False))


def pick(df: DataFrame, key: str, seed: int) -> DataFrame:
    """One row, the same for the same seed and rows: that of the least hash of seed and key."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(1)


def detectors() -> dict[str, Column]:
    """Named patterns of raw observations: conditions on TMP, VIS, WND and AA1."""
    t, v, direction, speed = (F.trim(F.get(F.split(c, ","), F.lit(n))) for c, n in (("TMP", 0), ("VIS", 0), ("WND", 0), ("WND", 3)))
    period, amount = (F.trim(F.get(F.split("AA1", ","), F.lit(n))) for n in (0, 1))
    signed, digits = r"^[+-]?\d+$", r"^\d+$"
    valid = [t.rlike(signed) & ~t.isin("+9999", "-9999"), v.rlike(digits) & (v != "999999"), speed.rlike(digits) & (speed != "9999")]
    missing = [t.isin("+9999", "-9999"), v == "999999", speed == "9999"]
    some = lambda xs: reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in xs])
    return {
        "tmp_missing_sentinel": t == "+9999", "tmp_negative_sentinel": t == "-9999", "vis_missing_sentinel": v == "999999", "wnd_calm_valid": (direction == "000") & (speed == "0000"),
        "wnd_missing_dir_valid_spd": (direction == "999") & valid[2], "wnd_fully_missing": (direction == "999") & (speed == "9999"),
        "aa1_valid_precip": period.rlike(digits) & (period != "99") & amount.rlike(digits) & (amount != "9999"), "aa1_missing_sentinel": amount == "9999",
        "mixed_validity": some(valid) & some(missing), "multi_family_informative": (t != "") & (v != "") & (direction != "") & (period != ""),
    }


def matches(df: DataFrame) -> DataFrame:
    """One row for each pattern that a row of df matches: its columns and pattern."""
    found = F.array_compact(F.array(*[F.when(c, k) for k, c in detectors().items()]))
    return df.withColumn("pattern", F.explode(found))
