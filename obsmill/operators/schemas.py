"""Pieces of a table with unlike columns as one, and columns of numbers kept as text."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmill.functions.decode import number
from obsmill.operators.cleaning import readable, with_usability
from obsmill.plans.rules import FAMILIES, PREFIXES, REPEATS, resolve

WHOLE = ("tinyint", "smallint", "int", "bigint")
REAL = ("float", "double")


def merged_order(schemas: list[list[str]]) -> list[str]:
    """All columns in an order that keeps every schema's own; among those free to come next the one first seen. Contradictory orders are an error."""
    seen = list(dict.fromkeys(c for s in schemas for c in s))
    before: dict[str, set[str]] = {c: set() for c in seen}
    for s in schemas:
        for left, right in zip(s, s[1:], strict=False):
            before[right].add(left)
    out: list[str] = []
    while len(out) < len(seen):
        placed = set(out)
        following = next((c for c in seen if c not in placed and before[c] <= placed), None)
        if following is None:
            raise ValueError(f"schemas contradict one another in the order of {', '.join(c for c in seen if c not in placed)}")
        out.append(following)
    return out


def common_type(kinds: list[str]) -> str:
    """One type for values of several: text with any text, the wider number of numbers, else text."""
    found = set(kinds)
    if len(found) == 1:
        return kinds[0]
    if found <= {*WHOLE}:
        return "bigint"
    if found <= {*WHOLE, *REAL} or all(k in (*WHOLE, *REAL) or k.startswith("decimal") for k in found):
        return "double"
    return "string"


def aligned(pieces: list[DataFrame]) -> DataFrame:
    """The pieces by column name as one table: missing columns are typed nulls; a piece whose columns changed gets its usability anew."""
    order = merged_order([p.columns for p in pieces])
    kinds = {c: common_type([dict(p.dtypes)[c] for p in pieces if c in p.columns]) for c in order}
    out = []
    for p in pieces:
        full = p.select(*[(F.col(f"`{c}`") if c in p.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in order])
        if p.columns != order and any(c.endswith("__qc_pass") for c in order):
            full = with_usability(full).select(*order, *[c for c in ("row_has_any_usable_metric", "usable_metric_count", "usable_metric_fraction") if c not in order])
        out.append(full)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


@lru_cache
def rollups() -> dict[str, str]:
    """How each readable column of all families is rolled up."""
    out = {}
    for x in [*FAMILIES, *[p for p in PREFIXES if p not in REPEATS], *[f"{p}{k}" for p, most in REPEATS.items() for k in range(1, most + 1)]]:
        parts = resolve(x)
        if parts is None:
            continue
        by_field = {("q%d" % n if p.kind == "quality" else p.name or f"part{n}"): p.rollup for n, p in enumerate(parts, 1)}
        out |= {name: by_field.get(path[1], "drop") for name, path in readable(x).items() if len(path) == 2}
    return out


def is_quality(column: str) -> bool:
    return column.endswith(("__quality", "__qc"))


def dropped(column: str) -> bool:
    """Whether a column has no place in a rollup: quality codes and parts whose rule says so."""
    return is_quality(column) or rollups().get(column) == "drop"


def drop_metadata(df: DataFrame, keys: tuple[str, ...] = ("ID", "Year", "MonthNum", "Day", "Hour")) -> DataFrame:
    return df.drop(*[c for c in df.columns if c not in keys and dropped(c)])


def numeric_texts(df: DataFrame, keys: list[str]) -> list[str]:
    """The text columns that hold a number somewhere, found in one aggregate; keys, quality codes and dropped classes aren't asked."""
    asked = [c for c, t in df.dtypes if t == "string" and c not in keys and not dropped(c)]
    if not asked:
        return []
    found = df.agg(*[F.coalesce(F.bool_or(number(F.col(f"`{c}`")).isNotNull()), F.lit(False)).alias(c) for c in asked]).first()
    return [c for c in asked if found[c]]


def coerce_numeric(df: DataFrame, keys: list[str]) -> DataFrame:
    """df with those text columns as doubles: what isn't a number there becomes null."""
    made = {c: number(F.col(f"`{c}`")) for c in numeric_texts(df, keys)}
    return df.withColumns(made) if made else df
