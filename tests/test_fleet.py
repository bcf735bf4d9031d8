"""Ranks, selections, gaps, files, schemas, profiles and typed columns: small cases worked out here."""

import hashlib
import random
from datetime import datetime, timedelta

import duckdb
import pytest

from obsmill import publication_queries, queries
from obsmill.operators import gaps, profiles, quality, ranking, schemas
from obsmill.sources import folders


def spread(total, count):
    """Evenly spaced places, worked out step by step."""
    if count >= total:
        return [*range(total)]
    return [total // 2] if count == 1 else [round(i * (total - 1) / (count - 1)) for i in range(count)]


def selection(rows, count, explicit):
    """Keys picked from rows of (size, key), by lists and not by ranks."""
    rows = sorted(rows)
    labels = [i * 4 // len(rows) for i in range(len(rows))]
    quota = [count // 4 + (q < count % 4) for q in range(4)]
    picked = [r for r in rows if r[1] in explicit]
    for r in picked:
        q = labels[rows.index(r)]
        quota[q] = max(0, quota[q] - 1)
    last = [r for r, q in zip(rows, labels, strict=True) if q == 3 and r not in picked]
    tail = last[len(last) - min(max(1, count // 25), quota[3], len(last)) :]
    picked += tail
    quota[3] -= len(tail)
    for q in range(4):
        free = [r for r, k in zip(rows, labels, strict=True) if k == q and r not in picked]
        picked += [free[i] for i in spread(len(free), quota[q])] if quota[q] else []
    picked += [r for r in rows if r not in picked][: max(0, count - len(picked))]
    return [k for _, k in sorted(picked)[:count]]


@pytest.mark.parametrize(("n", "count", "explicit"), [(1, 1, ()), (3, 10, ()), (40, 7, (3, 4)), (101, 53, (0, 50, 100, 7)), (60, 60, ()), (60, 59, (1,)), (30, 2, (1, 2, 3)), (57, 30, tuple(range(12)))])
def test_stratified(spark, n, count, explicit):
    rnd = random.Random(n * count)
    rows = [(rnd.randint(0, n // 2), k) for k in range(n)]
    df = spark.createDataFrame(rows, "size long, key int").repartition(3)
    got = ranking.select_stratified(df, "size", "key", count, explicit, ranges=5).orderBy("selection_rank").collect()
    assert [r.key for r in got] == selection(rows, count, explicit)


def test_unknown_key_and_empty_table(spark):
    df = spark.createDataFrame([(5, 1)], "size long, key int")
    with pytest.raises(KeyError):
        ranking.select_stratified(df, "size", "key", 1, (9,))
    assert ranking.select_stratified(df.limit(0), "size", "key", 3).collect() == []


def test_rank_of_ties_without_a_single_task(spark, capsys):
    df = spark.createDataFrame([(i % 3 if i % 4 else None, i) for i in range(2000)], "size long, key int").repartition(4)
    ranked, n = ranking.global_rank(df, ["size", "key"], ranges=16)
    rows = sorted((r["size"], r["key"]) for r in df.dropna().collect())
    assert n == len(rows) and {(r["size"], r["key"]): r["rank"] for r in ranked.collect()} == {x: k for k, x in enumerate(rows, 1)}
    ranked.explain()
    assert "SinglePartition" not in capsys.readouterr().out


def test_runs_over_new_year(spark):
    at = datetime(2020, 12, 28)
    rows = [("A", at + timedelta(hours=6 * i), i, None if 5 <= i < 40 or i in (45, 46) else 1.0) for i in range(60)]
    rows += [("B", at + timedelta(days=300 * i), i, None) for i in range(5)] + [("C", at, 1, 2.0), ("C", None, 2, None)]
    df = spark.createDataFrame(rows, "STATION string, DATE timestamp_ntz, obs_id int, x double").repartition(4)
    got = {r.STATION: (r.length, r.begin, r.end, r.hours) for r in gaps.longest_missing_run(df, "x").collect()}
    assert got == {"A": (35, rows[5][1], rows[39][1], 34 * 6.0), "B": (5, at, at + timedelta(days=1200), 28800.0)}
    assert gaps.missing_runs(df, "x").where("STATION = 'A'").count() == 2


def test_digests_states_and_schemas(spark, tmp_path):
    files = {"a/x.txt": b"one", "b/y.txt": b"", "c/z.txt": b"large" * 99}
    for name, content in files.items():
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_bytes(content)
    found = folders.digests(folders.contents(spark, f"file://{tmp_path}", most=100))
    want = {n: hashlib.sha256(c + b"\0").hexdigest() for n, c in files.items()}
    assert {r.path: r.checksum for r in found.collect()} == {"a/x.txt": want["a/x.txt"], "c/z.txt": None}
    manifest = spark.createDataFrame([("1", "a/x.txt", want["a/x.txt"]), ("2", "a/x.txt", "0" * 64), ("5", "b/y.txt", want["b/y.txt"]), ("3", "no.txt", "x"), ("4", "c/z.txt", want["c/z.txt"])], "artifact_id string, path string, checksum string")
    assert {r.artifact_id: r.state for r in folders.conformance(manifest, found).collect()} == {"1": "ok", "2": "altered", "3": "missing", "4": "unread", "5": "missing"}
    rows = spark.createDataFrame([("a", ["x", "y"]), ("b", ["y", "x"]), ("c", ["x", "z"]), ("d", ["x", "y"]), ("e", [])], "path string, columns array<string>")
    got = {r.path: (r.missing, r.added, r.reordered) for r in folders.schema_deviations(rows).collect()}
    assert got == {"b": ([], [], True), "c": (["y"], ["z"], False), "e": (["x", "y"], [], False)}
    assert folders.schema_deviations(rows.limit(0)).collect() == []


def test_scan_opens_only_the_stations_asked_for(spark, tmp_path):
    for name in ("00000000001", "0000000000A", "bad-name-00", "000000000011"):
        spark.range(3).write.parquet(f"{tmp_path}/{name}/Raw.parquet")
    rows = folders.scan(spark, str(tmp_path), "Raw.parquet")
    assert {r.station_id: r["count"] for r in rows.groupBy("station_id").count().collect()} == {"00000000001": 3, "0000000000A": 3}
    some = folders.scan(spark, str(tmp_path), "Raw.parquet", ["00000000001"])
    assert some.count() == 3 and all("/00000000001/" in f for f in some.inputFiles())
    with pytest.raises(ValueError):
        folders.scan(spark, str(tmp_path), "Raw.parquet", ["../secret"])
    assert [r.station_id for r in folders.discover(spark, str(tmp_path), "Raw.parquet").orderBy("station_id").collect()] == ["00000000001", "0000000000A"]


def test_csv_headers_with_quotes(spark, tmp_path):
    for name, text in {"1": 'id,"a,b"\n1,"x,y"\n2,NA\n', "2": '"a,b",id,c\nq,7,"line ""q"""\n', "3": "id\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    df = folders.read_csv_folder(spark, f"{tmp_path}/*.csv").select("id", "`a,b`", "c")
    assert sorted(map(tuple, df.collect())) == [("1", "x,y", None), ("2", None, None), ("7", "q", 'line "q"')]


def test_order_and_types_of_schemas():
    assert schemas.merged_order([["a", "d"], ["a", "b", "d"], ["z", "b", "c"]]) == ["a", "z", "b", "d", "c"]
    with pytest.raises(ValueError):
        schemas.merged_order([["a", "b"], ["b", "a"]])
    assert [schemas.common_type(k) for k in (["int", "bigint"], ["int", "double"], ["boolean", "int"], ["date", "date"], ["string", "double"])] == ["bigint", "double", "string", "date", "string"]
    assert schemas.dropped("WND__quality") and schemas.dropped("precip_period_hours_2") and not schemas.dropped("precip_amount_2")


def test_numbers_in_text(spark):
    df = spark.createDataFrame([("k", "x", "+1.5", None, "1"), ("k", "y", "no", None, "2")], "ID string, a string, b string, c string, VIS__quality string")
    out = schemas.coerce_numeric(df, ["ID"])
    assert out.dtypes == [("ID", "string"), ("a", "string"), ("b", "double"), ("c", "string"), ("VIS__quality", "string")]
    assert [r.b for r in out.collect()] == [1.5, None]


def test_profiles_of_parts_are_those_of_the_whole(spark):
    from obsmill.operators import cleaning

    rows = [("S", i % 3, ["+0100,1", "+9999,9", "+0050,8", "x,1", None][i % 5], ["010000,1,N,1", "999999,9,N,1", "1,1"][i % 3]) for i in range(30)]
    x = cleaning.clean(spark.createDataFrame(rows, "STATION string, part int, TMP string, VIS string"))
    whole = profiles.full_profile(x, ["TMP", "VIS"], ["STATION"], compat=False)
    parts = profiles.to_json(profiles.full_profile(x, ["TMP", "VIS"], ["STATION", "part"], compat=False), ["STATION", "part"])
    merged = profiles.merge(profiles.from_json(parts, ["STATION", "part"]), ["STATION"])
    (a,), (b,) = whole.collect(), merged.select(whole.columns).collect()
    assert a == b
    assert a.null_counts_by_identifier == {"TMP": 24, "VIS": 20} and a.rule_family_impact_counts["sentinel_handling"] == 16
    assert a.qc_flag_counts_by_identifier["TMP"] == 18 and a.rule_family_impact_counts["quality_code_handling"] == 6 and a.rule_family_impact_counts["width_validation"] == 6


def test_distribution_has_one_buffer_and_extremes_their_ties(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 2, 3, 10)] + [("b", None)], "k string, x double")
    out = quality.distribution(df, "x", ["k"])
    got = {r.k: tuple(r)[1:] for r in out.collect()}
    assert got["a"] == pytest.approx((5, 1.0, 10.0, 3.6, 1.2, 2.0, 2.0, 3.0, 8.6)) and got["b"] == (0, *[None] * 8)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("percentile(") == 1
    ties = spark.createDataFrame([(s, v) for v in (1.0, 2.0) for s in "dcba"], "s string, v double")
    assert [tuple(r) for r in quality.extremes(ties, "v", ["s", "v"], False, 3).orderBy("place").collect()] == [(1, "a", 2.0), (2, "b", 2.0), (3, "c", 2.0)]


def test_sorted_csv_rounds_as_printf(spark, tmp_path):
    """Balances a little under a half, exact halves, nulls and values that aren't numbers, against the query's SQL."""
    cells = [6959.15, 5014.95, 7211.25, 0.25, 0.35, -425.45, -0.04, 0.05, 1e22, 2.0**50 + 0.25, 123456789.05, None, float("inf"), float("nan")]
    rows = [(5 * k + 1, x) for k, x in enumerate(cells)] + [(5, 1.0), (None, 2.0)]
    spark.createDataFrame(rows, "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    con = duckdb.connect()
    con.execute(f"create view supplier as select * from read_parquet('{tmp_path}/supplier.parquet/*.parquet')")
    got = publication_queries.sorted_csv(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(con.execute(queries.SQL["S06_sorted_csv"]).fetchall(), key=str)
