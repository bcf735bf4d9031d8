"""Full quality profiles of stations, with counts by identifier and rule family as maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmill.operators.cleaning import FAMILY_OF, profile, readable

#: Rule families, and those of flags by the flags' names.
RULE_FAMILIES = ("sentinel_handling", "arity_validation", "domain_validation", "range_validation", "pattern_validation", "width_validation", "structural_validation", "structural_parser_guard", "quality_code_handling")
FLAG_FAMILIES = {"qc_domain_invalid_": "domain_validation", "qc_control_invalid_": "structural_validation", "qc_pattern_mismatch_": "pattern_validation", "qc_arity_mismatch_": "arity_validation"}
MAPS = ("null_counts_by_identifier", "qc_flag_counts_by_identifier", "rule_family_impact_counts")
COUNTS = ("rows_total", "rows_with_qc_flags", "rows_with_structural_impacts", "rows_with_sentinel_impacts", "rows_with_quality_code_impacts", "rows_with_other_substantive_impacts")


def _summed(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns, F.lit(0).cast("long"))


def _map(made: dict[str, Column], zeros: bool) -> Column:
    if not made:
        return F.from_json(F.lit("{}"), "map<string, bigint>")
    names = sorted(made)
    whole = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[made[k] for k in names]))
    return whole if zeros else F.map_filter(whole, lambda _, n: n > 0)


def maps(df: DataFrame, identifiers: list[str], by: list[str]) -> DataFrame:
    """(*by and the three maps): rows in which any value of an identifier is null; verdicts with a reason and flags by identifier; both by rule family.

    One aggregate over df. Identifiers without nulls or flags have no key, rule families always have one.
    """
    counts: dict[str, Column] = {}
    nulls, flags, families = {}, {}, {f: [] for f in RULE_FAMILIES}
    for n, x in enumerate(identifiers):
        made = {name: path for name, path in readable(x).items() if name in df.columns}
        values = [F.col(c).isNull() for c, path in made.items() if len(path) == 2 and not c.startswith("qc_") and path[1] != "quality" and not (path[1][:1] == "q" and path[1][1:].isdigit())]
        reasons = [F.col(c) for c, path in made.items() if len(path) == 3 and path[2] == "reason"]
        if values:
            nulls[x] = counts.setdefault(f"null{n}", F.count_if(reduce(lambda a, b: a | b, values)))
        if reasons:
            each = {f: F.sum(_summed([F.coalesce((r == k).cast("long"), F.lit(0)) for r in reasons])) for k, f in FAMILY_OF.items()}
            for f, c in each.items():
                families[f].append(f"{f}{n}")
                counts[f"{f}{n}"] = c
            counts[f"reason{n}"] = F.sum(_summed([r.isNotNull().cast("long") for r in reasons]))
            flags.setdefault(x, []).append(f"reason{n}")
    for n, c in enumerate(c for c in df.columns if c.startswith("qc_")):
        prefix = next((p for p in FLAG_FAMILIES if c.startswith(p)), None)
        if prefix:
            counts[f"flag{n}"] = F.count_if(F.coalesce(F.col(c), F.lit(False)))
            flags.setdefault(c[len(prefix) :], []).append(f"flag{n}")
            families[FLAG_FAMILIES[prefix]].append(f"flag{n}")
    if "__parse_error" in df.columns:
        counts["parse"] = F.count_if(F.col("__parse_error").isNotNull())
        families["structural_parser_guard"].append("parse")
    made = df.groupBy(*by).agg(*[c.alias(k) for k, c in counts.items()]) if counts else df.select(*by).distinct()
    null_of = {x: F.col(f"null{n}") for n, x in enumerate(identifiers) if x in nulls}
    by_identifier = {x: _summed([F.coalesce(F.col(k), F.lit(0)) for k in ks]) for x, ks in flags.items()}
    by_family = {f: _summed([F.coalesce(F.col(k), F.lit(0)) for k in ks]) for f, ks in families.items()}
    return made.select(*by, _map(null_of, False).alias(MAPS[0]), _map(by_identifier, False).alias(MAPS[1]), _map(by_family, True).alias(MAPS[2]))


def _fractions(df: DataFrame) -> DataFrame:
    total = F.col("rows_total")
    share = lambda c: F.when(total > 0, F.col(c) / total).otherwise(F.lit(0.0))
    return df.withColumns({"fraction_rows_impacted": share("rows_with_qc_flags"), "fraction_rows_structural_impacted": share("rows_with_structural_impacts")})


def full_profile(df: DataFrame, identifiers: list[str], by: list[str], compat: bool = True) -> DataFrame:
    """Counts of rows by cause with their fractions, and the maps, one row a group of a cleaned table."""
    return _fractions(profile(df, by, compat).select(*by, *COUNTS).join(maps(df, identifiers, by), by))


def merge(partial: DataFrame, by: list[str]) -> DataFrame:
    """Profiles of parts of the groups as those of the groups: counts are summed, maps by key, fractions made again."""
    sums = partial.groupBy(*by).agg(*[F.sum(c).alias(c) for c in COUNTS])

    def entries_of(m: str) -> Column:
        return F.transform(F.map_entries(m), lambda e: F.struct(F.lit(m).alias("kind"), e["key"].alias("name"), e["value"].alias("n")))

    each = [entries_of(m) for m in MAPS]
    long = partial.select(*by, F.inline(F.concat(*each))).groupBy(*by, "kind", "name").agg(F.sum("n").alias("n"))
    entries = lambda m: F.array_sort(F.collect_list(F.when(F.col("kind") == m, F.struct("name", "n"))))  # noqa: E731 - nulls are left out
    return _fractions(sums.join(long.groupBy(*by).agg(*[F.map_from_entries(entries(m)).alias(m) for m in MAPS]), by))


def to_json(profiles: DataFrame, by: list[str]) -> DataFrame:
    """(*by, profile): each profile as JSON, keys in the order of the columns."""
    return profiles.select(*by, F.to_json(F.struct(*[c for c in profiles.columns if c not in by])).alias("profile"))


def from_json(texts: DataFrame, by: list[str]) -> DataFrame:
    kinds = ", ".join([f"{c} bigint" for c in COUNTS] + [f"{m} map<string, bigint>" for m in MAPS])
    return _fractions(texts.select(*by, F.from_json("profile", kinds).alias("x")).select(*by, "x.*"))
