"""Gates of publication: sentinel leaks, suspect values, run states, manifests with checksums and lineage, integrity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmill.operators.cleaning import readable
from obsmill.plans.rules import FAMILIES, resolve

TOLERANCE = 1e-6
SUSPECT = ("3", "7")
#: States of a run's stations, checks of integrity, upstream types that an artifact's type must refer to, and columns of a manifest.
STATES = ("completed", "failed", "retrying", "running", "pending", "skipped", "interrupted")
CHECKS = ("run_completion", "artifact_manifest_coverage", "timestamp_validity", "checksum_policy_conformance", "artifact_structural_sanity", "build_metadata_completeness")
UPSTREAM = {"canonical_dataset": ("raw_source",), "domain_dataset": ("canonical_dataset", "raw_source"), "quality_report": ("canonical_dataset",)}
ALSO = {"quality_report": "domain_dataset"}
MANIFEST = ("artifact_id", "artifact_type", "artifact_path", "checksum", "input_lineage", "creation_timestamp")


def sentinel_values() -> dict[str, tuple[float, ...]]:
    """The scaled sentinels of numeric columns; families told by their first letters aren't asked, only those with names of their own."""
    out = {}
    for x in FAMILIES:
        parts = resolve(x)
        for name, path in readable(x).items():
            part = next((p for n, p in enumerate(parts, 1) if len(path) == 2 and path[1] == (p.name or f"part{n}")), None)
            if part is not None and part.kind == "numeric" and part.sentinels:
                out[name] = tuple(sorted({round(float(s) * part.scale, 6) for s in part.sentinels}))
    return out


def sentinel_leaks(df: DataFrame, by: list[str]) -> DataFrame:
    """(*by, field, n_leaks): values of a cleaned table that are a sentinel of their column; one aggregate over df."""
    asked = {c: v for c, v in sentinel_values().items() if c in df.columns}
    leaked = lambda c, values: reduce(lambda a, b: a | b, [F.abs(F.col(c) - F.lit(v)) <= TOLERANCE for v in values])
    counts = df.groupBy(*by).agg(*[F.count_if(leaked(c, v)).alias(c) for c, v in asked.items()])
    return counts.unpivot(by, list(asked), "field", "n_leaks").where("n_leaks > 0")


def qualities(df: DataFrame, identifiers: list[str]) -> dict[str, str]:
    """The column of the quality code of each value column of a cleaned table."""
    out = {}
    for x in identifiers:
        parts = resolve(x)
        made = {path[1]: name for name, path in readable(x).items() if len(path) == 2}
        for n, p in enumerate(parts, 1):
            value = made.get(p.name or f"part{n}") if p.kind != "quality" else None
            code = made.get("quality" if len(parts) == 1 else f"q{p.quality}") if p.quality else None
            if value in df.columns and code in df.columns:
                out[value] = code
    return out


def null_suspects(df: DataFrame, identifiers: list[str]) -> DataFrame:
    """df with null for values whose quality code is 3 or 7 (suspect or erroneous)."""
    return df.withColumns({v: F.when(~F.coalesce(F.col(q).isin(*SUSPECT), F.lit(False)), F.col(v)) for v, q in qualities(df, identifiers).items()})


def suspects(df: DataFrame, identifiers: list[str], by: list[str]) -> DataFrame:
    """(*by, field, n_suspect, n_null_before, n_null_after): rows with such a code, and nulls before and after they are nulled."""
    found = qualities(df, identifiers)
    bad = {v: F.coalesce(F.col(q).isin(*SUSPECT), F.lit(False)) for v, q in found.items()}
    counts = df.groupBy(*by).agg(*[F.struct(F.count_if(b).alias("n_suspect"), F.count_if(F.col(v).isNull()).alias("n_null_before"), F.count_if(F.col(v).isNull() | b).alias("n_null_after")).alias(v) for v, b in bad.items()])
    return counts.select(*by, F.inline(F.array(*[F.struct(F.lit(v).alias("field"), *[F.col(v)[k].alias(k) for k in ("n_suspect", "n_null_before", "n_null_after")]) for v in found])))


def terminal_state(status: DataFrame, by: list[str], column: str = "status") -> DataFrame:
    """(*by, total, a count of each state, finalizable, state) of a table with a row a station; skips of any kind count as skipped."""
    s = F.when(F.col(column).startswith("skipped"), "skipped").otherwise(F.col(column))
    counts = status.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(s == k).alias(k) for k in STATES])
    done = (F.col("total") > 0) & (F.col("completed") == F.col("total"))
    return counts.withColumns({"finalizable": done, "state": F.when(done, "completed").when(F.col("failed") > 0, "failed").otherwise("interrupted")})


def progress(status: DataFrame, by: list[str], column: str = "status", size: str = "size_bytes", seconds: str = "elapsed_seconds") -> DataFrame:
    """How far batches are: fractions by stations and by bytes, mean and median seconds, what is left by each and by bytes.

    Medians come from counts of equal seconds, not from all values.
    """
    done = F.col(column) == "completed"
    took = F.when(done, F.col(seconds))
    counted = status.groupBy(*by, took.alias("took")).agg(F.count("*").alias("n"), F.count_if(done).alias("n_done"), F.sum(size).alias("bytes"), F.sum(F.when(done, F.col(size))).alias("done_bytes"), F.sum(took).alias("spent"))
    out = counted.groupBy(*by).agg(
        F.sum("n").alias("n_stations"), F.sum("n_done").alias("n_completed"), F.sum("bytes").alias("bytes_total"), F.coalesce(F.sum("done_bytes"), F.lit(0)).alias("bytes_completed"),
        F.try_divide(F.sum("spent"), F.sum("n_done")).alias("mean_seconds"), F.percentile("took", F.lit(0.5), F.when(F.col("took").isNotNull(), F.col("n")).otherwise(F.lit(0))).alias("median_seconds"), F.sum("spent").alias("spent"),
    )
    left = F.col("n_stations") - F.col("n_completed")
    return out.withColumns({
        "fraction_stations": F.try_divide("n_completed", "n_stations"), "fraction_bytes": F.try_divide("bytes_completed", "bytes_total"), "left_by_mean": left * F.col("mean_seconds"), "left_by_median": left * F.col("median_seconds"),
        "left_by_bytes": F.try_divide((F.col("bytes_total") - F.col("bytes_completed")) * F.col("spent"), F.when(F.col("bytes_completed") > 0, F.col("bytes_completed"))),
    }).drop("spent")


def ratio_bounds(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(name, within): whether all values of a column are numbers from 0 to 1. A table without the column fails, one without rows passes."""
    out = None
    for name, (df, column) in tables.items():
        value = F.col(column).try_cast("double") if column in df.columns and dict(df.dtypes)[column] == "string" else F.col(column) if column in df.columns else None
        ok = F.lit(False) if value is None else F.coalesce(F.bool_and(F.coalesce(value.between(0, 1), F.lit(False))), F.lit(True))
        part = df.agg(F.lit(name).alias("name"), ok.alias("within")) if value is not None else df.agg(F.count("*")).select(F.lit(name).alias("name"), ok.alias("within"))
        out = part if out is None else out.unionAll(part)
    return out


def manifest_faults(manifest: DataFrame, key: str = "artifact_id", timestamp: str = "creation_timestamp", columns: tuple[str, ...] = MANIFEST) -> DataFrame:
    """(fault, subject, n): columns that lack, ids that several rows have, rows whose time isn't an ISO one with a time of day."""
    lacking = [c for c in columns if c not in manifest.columns]
    out = manifest.sparkSession.createDataFrame([("missing_column", c, 1) for c in lacking], "fault string, subject string, n long")
    if key in manifest.columns:
        twice = manifest.groupBy(F.col(key).cast("string").alias("subject")).agg(F.count("*").alias("n")).where("n > 1")
        out = out.unionByName(twice.select(F.lit("duplicate_id").alias("fault"), "subject", "n"))
    if key in manifest.columns and timestamp in manifest.columns:
        t = F.col(timestamp).cast("string")
        good = t.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d") & F.try_to_timestamp(t).isNotNull()
        wrong = manifest.where(~F.coalesce(good, F.lit(False))).groupBy(F.col(key).cast("string").alias("subject")).agg(F.count("*").alias("n"))
        out = out.unionByName(wrong.select(F.lit("timestamp").alias("fault"), "subject", "n"))
    return out


def row_text(columns: list[str]) -> Column:
    """A row's values as one text: each with its length before it, so that no two rows share a text; null has a mark of its own."""
    return F.concat(*[F.when(F.col(c).isNull(), F.lit("n;")).otherwise(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"), F.lit(";"))) for c in columns])


def checksums(df: DataFrame, artifact: str, columns: list[str]) -> DataFrame:
    """(artifact, n_rows, checksum): SHA-256 over four sums of the rows' SHA-256, so that neither order nor partitions matter.

    The sums are of 60 bits each, exact in decimals; a row that is there twice counts twice.
    """
    digest = F.sha2(row_text(columns), 256)
    lanes = df.select(F.col(artifact), *[F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)").alias(f"s{k}") for k in range(4)])
    sums = lanes.groupBy(artifact).agg(F.count("*").alias("n_rows"), *[F.sum(f"s{k}").cast("string").alias(f"s{k}") for k in range(4)])
    return sums.select(artifact, "n_rows", F.sha2(F.concat_ws("|", F.col("n_rows").cast("string"), *[f"s{k}" for k in range(4)]), 256).alias("checksum"))


def lineage_faults(manifest: DataFrame) -> DataFrame:
    """(artifact_id, fault, detail): references that no row has as its id, and artifacts that refer to none of the type they must.

    A type is asked for only where the manifest has rows of it; a domain dataset then must refer to canonical ones,
    or to raw sources where there are no canonical ones.
    """
    kinds = {r[0] for r in manifest.select("artifact_type").distinct().limit(100).collect()}
    refs = manifest.select("artifact_id", F.explode(F.from_json("input_lineage", "array<string>")).alias("reference"))
    known = manifest.select(F.col("artifact_id").alias("reference"), F.col("artifact_type").alias("of_type")).distinct()
    resolved = refs.join(known, "reference", "left")
    named = F.col("reference").rlike("^(raw_source|canonical_dataset|domain_dataset)/")
    unresolved = resolved.where(F.col("of_type").isNull() & named).select("artifact_id", F.lit("unresolved").alias("fault"), F.col("reference").alias("detail"))
    met = resolved.where(F.col("of_type").isNotNull()).groupBy("artifact_id").agg(F.collect_set("of_type").alias("met"))
    needs = F.array().cast("array<string>")
    for kind, choices in UPSTREAM.items():
        wanted = [next((c for c in choices if c in kinds), None), ALSO.get(kind) if ALSO.get(kind) in kinds else None]
        needs = F.when(F.col("artifact_type") == kind, F.array(*[F.lit(w) for w in wanted if w]).cast("array<string>")).otherwise(needs)
    asked = manifest.select("artifact_id", needs.alias("needs")).join(met, "artifact_id", "left")
    lacking = asked.select("artifact_id", F.lit("no_upstream").alias("fault"), F.explode(F.array_except("needs", F.coalesce("met", F.array().cast("array<string>")))).alias("detail"))
    return unresolved.unionAll(lacking)


def integrity(checks: DataFrame) -> DataFrame:
    """(score, n_passed) from rows (name, passed): the share of the six checks that passed; one that lacks didn't."""
    passed = checks.where(F.col("name").isin(*CHECKS)).groupBy("name").agg(F.bool_and(F.coalesce("passed", F.lit(False))).alias("ok"))
    return passed.agg(F.count_if("ok").alias("n_passed")).select((F.col("n_passed") / len(CHECKS)).alias("score"), "n_passed")


def not_used_before(candidates: DataFrame, manifests: DataFrame, asked: list[str], key: str = "station_id") -> DataFrame:
    """Candidates that no earlier run's manifest names, and those asked for by name all the same."""
    before = manifests.where(F.col("artifact_type") == "raw_source").select(F.element_at(F.split("artifact_id", "/"), -1).alias(key)).distinct()
    return candidates.join(before, key, "left_anti").unionByName(candidates.where(F.col(key).isin(*asked)).join(before, key, "left_semi"))
