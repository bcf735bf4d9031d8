"""Decoding rules on literal cells, sources, and streaming."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from obsmill.functions import decode as d
from obsmill.plans.rules import resolve
from obsmill.sources import tables
from obsmill.streaming import incremental


@pytest.mark.parametrize(
    ("cell", "value", "reason"),
    [
        ("+0180,1", 18.0, None), ("-0045,1", -4.5, None), ("+9999,9", None, "SENTINEL_MISSING"), ("+12A4,1", None, "MALFORMED_TOKEN"), ("+0180,8", None, "BAD_QUALITY_CODE"),
        ("+180,1", None, "MALFORMED_TOKEN"), ("+0700,1", None, "OUT_OF_RANGE"), ("+9999,8", None, "BAD_QUALITY_CODE"), (" +0180,1", None, "MALFORMED_TOKEN"), ("+0618,1", 61.8, None),
    ],
)
def test_verdict_priority(spark, cell, value, reason):
    row = d.decode(spark.createDataFrame([(cell,)], "TMP string"), "TMP").first()["tmp_"]
    assert row["temperature_c"] == (None if value is None else pytest.approx(value))
    assert row["temperature_c_qc"]["reason"] == reason
    assert row["temperature_c_qc"]["pass"] == (reason is None)


def test_multi_part(spark):
    rows = [("090,1,N,0031,1",), ("999,9,V,0031,1",), ("999,9,9,0000,1",), ("090,1,N,0031",), (None,), ("",)]
    got = [r["wnd_"] for r in d.decode(spark.createDataFrame(rows, "WND string"), "WND").collect()]
    assert (got[0]["wind_direction_deg"], got[0]["wind_speed_ms"], got[0]["wind_type_code"]) == (90.0, pytest.approx(3.1), "N")
    assert got[1]["wind_direction_deg"] is None and got[1]["direction_variable"]
    assert got[2]["calm"] and got[2]["wind_speed_ms"] == 0.0
    assert all(g["wind_speed_ms"] is None and g["wind_speed_ms_qc"] is None for g in got[3:])


def test_resolution():
    assert resolve("AA4") and resolve("AA5") is None and resolve("XX1") is None
    assert [p.kind for p in resolve("WND")] == ["numeric", "quality", "categorical", "numeric", "quality"]


def test_csv_and_stream(spark, tmp_path):
    (tmp_path / "a.csv").write_text("STATION,TMP\nx,\"+0180,1\"\ny,NA\n")
    df = tables.read_csv(spark, str(tmp_path / "a.csv"), ["STATION", "TMP"])
    assert [r["TMP"] for r in df.orderBy("STATION").collect()] == ["+0180,1", None]
    stacked = tables.stack_years({2001: df, 2000: df.drop("TMP")})
    assert stacked.where("TMP is null").count() == 3
    tables.write_sorted(df, str(tmp_path / "in"), ["STATION"])
    stream = incremental.clean_arriving(spark, str(tmp_path / "in"), df.schema, ["TMP"])
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


@pytest.mark.parametrize(
    ("family", "cell", "field", "value", "reason"),
    [
        ("SA1", "0250,4", "sea_surface_temperature_c", None, "BAD_QUALITY_CODE"), ("SA1", "0250,1", "sea_surface_temperature_c", 25.0, None), ("UG1", "05,010,720,1", "swell_direction_deg", None, None),
        ("UG1", "05,010,180,1", "swell_direction_deg", 180.0, None), ("UG1", "99,010,180,1", "swell_period_seconds", None, "SENTINEL_MISSING"), ("MD1", "3,1,010,1,+0900,1", "pressure_change_24hr_hpa", None, "OUT_OF_RANGE"),
        ("CB1", "05,00010,9,0", "part2", None, "SENTINEL_MISSING"), ("MA1", "10132,8,09990,1", "altimeter_setting_hpa", None, "BAD_QUALITY_CODE"), ("KA1", "120,M,+0353,1", "extreme_temp_c", 35.3, None),
        ("ED1", "36,L,0550,1", "runway_direction_deg", 360.0, None), ("CO2", "ABC,+0010", "part2", 1.0, None), ("CIG", "30000,1,9,N", "ceiling_height_m", 22000.0, None), ("OE1", "1,24,01000,180,1260,4", "part5", None, None),
    ],
)
def test_families(spark, family, cell, field, value, reason):
    x = d.decode(spark.createDataFrame([(cell,)], f"{family} string"), family).first()[f"{family.lower()}_"]
    assert x[field] == (None if value is None else pytest.approx(value))
    assert x[f"{field}_qc"]["reason"] == reason


def test_codes(spark):
    df = spark.createDataFrame([("9,1,010,1,+0010,1", "25,C,1")], "MD1 string, AC1 string")
    x = d.decode_all(df, ["MD1", "AC1"]).first()
    assert x["md1_"]["pressure_tendency_code"] is None
    assert x["ac1_"]["part1"] is None  # of the wrong width


def test_no_cell_is_split_twice(spark):
    df = spark.createDataFrame([("+0180,1", "090,1,N,0031,1")], "TMP string, WND string")
    plan = d.decode_all(df, ["TMP", "WND"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 2


def test_equal_names_are_refused(spark):
    from obsmill.operators import cleaning

    df = spark.createDataFrame([("+0180,1", "x")], "TMP string, temperature_c string")
    with pytest.raises(ValueError, match="temperature_c"):
        cleaning.clean(df)


def test_views_and_contract(spark, tmp_path):
    from obsmill.operators import cleaning

    df = spark.createDataFrame([("1", "20240101", "+0180,1", "090,1,N,0031,1"), ("2", "20240102", None, "x")], "STATION string, DATE string, TMP string, WND string")
    x = cleaning.with_contract(cleaning.clean(df))
    manifest = {r["domain"]: r["n_rows"] for r in cleaning.write_views(x, str(tmp_path)).collect()}
    assert manifest == {"metadata": 2, "wind": 2, "pressure_temperature": 2}
    assert cleaning.contract_faults(x).count() == 0
    assert cleaning.view(x, "remarks") is None
    assert set(cleaning.split_by_class(x)) >= {"temperature", "wind"}
    assert cleaning.clean(df.limit(0)).count() == 0


@pytest.mark.parametrize(("most", "seconds"), [(40, 30), (200, 45)])
def test_wide_tables_are_planned_in_time(spark, most, seconds):
    """Bounds with room for slow machines; as columns of the API the plans alone took minutes."""
    import time

    from obsmill.operators import cleaning
    from obsmill.plans.rules import FAMILIES, PREFIXES, REPEATS, resolve

    names, seen = [], set()
    for x in [*FAMILIES, *[p + ("1" if p in REPEATS else "") for p in PREFIXES]]:
        made = set(cleaning.readable(x)) if resolve(x) else seen
        if made and not made & seen:
            names.append(x)
            seen |= made
    df = spark.createDataFrame([("+0100,1",) * len(names[:most])], ", ".join(f"{n} string" for n in names[:most]))
    began = time.time()
    rows = cleaning.clean(df).collect()
    assert len(rows) == 1 and time.time() - began < seconds
