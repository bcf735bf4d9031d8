"""Registered queries of summaries of a fleet, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsmill.clean_queries import W_LINES, W_PATTERNS, W_USE, W_VERDICTS, lines
from obsmill.operators import cleaning, profiles, summaries
from obsmill.queries import W_OBS, W_TMP, obs, query, rounded

FAMILY = "case x.reason when 'SENTINEL_MISSING' then 'sentinel_handling' when 'BAD_QUALITY_CODE' then 'quality_code_handling' when 'OUT_OF_RANGE' then 'range_validation' when 'MALFORMED_TOKEN' then 'width_validation' end"


@query("G17_totals_and_leaders", W_VERDICTS + f""", r as (select obs_id, STATION, bool_or(x.reason is not null) as hit from vd group by all), s as (select STATION, count(*) as n, count(*) filter (hit) / count(*) as rate from r group by STATION), w as (select count(*) as k, cast(sum(n) as bigint) as n, avg(rate) as rate from s),
 i as (select x.identifier as name, count(*) as n from vd where x.reason is not null group by all union all select c, n from w, (values ('CONTROL'), ('date')) as t(c)),
 f as (select f as name, coalesce(n, 0) + case when f in ('domain_validation', 'structural_validation') then (select n from w) else 0 end as n from (values ('sentinel_handling'), ('arity_validation'), ('domain_validation'), ('range_validation'), ('pattern_validation'), ('width_validation'), ('structural_validation'), ('structural_parser_guard'), ('quality_code_handling')) as t(f)
  left join (select {FAMILY} as g, count(*) as n from vd where x.reason is not null group by all) on f = g)
 select 'total' as section, 'stations' as name, k as n, null::double as rate from w union all select 'total', 'rows', n, null from w union all select 'average', 'fraction_rows_impacted', null, round(rate, 6) from w union all select 'average', 'fraction_rows_structural_impacted', null, 0.0 from w
 union all (select 'identifier', name, n, round(n / (select n from w), 6) from i order by n desc, name desc limit 10) union all select 'family', name, n, null from f""")
def totals_and_leaders(spark, sf_dir):
    p = profiles.full_profile(cleaning.clean(obs(spark, sf_dir)), ["TMP", "WND", "VIS", "AA1"], ["STATION"], compat=False)
    return rounded(summaries.fleet_summary(p), "rate", to=6)


#: Station 0 has no missing values, but latitudes that aren't valid.
HALF = """select cast(event_id % 3 as int) as STATION, case when event_id % 3 = 0 then '+0180,1' when event_id % 2 = 0 then '+9999,9' else '+0180,1' end as TMP,
 case when event_id % 3 = 0 and event_id % 4 = 0 then 'north' else '+45000' end as LATITUDE from {events}"""


@query("G18_all_without_nulls", """with e as (select cast(event_id % 3 as integer) as STATION, event_id as e from events), n as (select STATION, count(*) as rows_total, count(*) filter (e % 2 = 0) as t, count(*) filter (e % 4 = 0) as l from e group by STATION),
 x as (select STATION, '__all__' as field, rows_total, l as null_count from n where STATION = 0 union all select STATION, 'TMP', rows_total, t from n where STATION > 0) select *, round((rows_total - null_count) / rows_total, 6) as ratio from x""")
def all_without_nulls(spark, sf_dir):
    df = spark.sql(HALF, events=spark.read.parquet(f"{sf_dir}/events.parquet"))
    p = profiles.full_profile(cleaning.clean(df), ["TMP"], ["STATION"])
    return rounded(summaries.completeness(p, ["STATION"]), "ratio", to=6)


@query("O03_inputs_and_schemas", """with s as (select o_orderkey as station_id, case when o_orderkey % 7 = 0 then 0.0 else o_custkey * 1000.0 + o_orderkey % 1000 end::double as input_size_bytes, (o_orderkey % 977)::double as cleaned_columns from orders where o_orderstatus = 'F')
 select 'largest_input_stations' as list, row_number() over (order by input_size_bytes desc, station_id) as place, * from s qualify place <= 5 union all select 'widest_cleaned_schemas', row_number() over (order by cleaned_columns desc, station_id) as place, * from s qualify place <= 5""")
def inputs_and_schemas(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    size = F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise((F.col("o_custkey") * 1000 + F.col("o_orderkey") % 1000).cast("string"))
    status = o.select(F.col("o_orderkey").alias("station_id"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("running").alias("status"), size.alias("input_size_bytes"), (F.col("o_orderkey") % 977).alias("cleaned_columns"))
    return summaries.outliers(status)


@query("J15_by_metric", W_TMP + """, m as (select STATION, 'temperature_c' as field, sent as s, temperature_c is null as z from tmp union all select STATION, 'wind_direction_deg', string_split(WND, ',')[1] = '999', string_split(WND, ',')[1] = '999' from tmp
 union all select STATION, 'wind_speed_ms', string_split(WND, ',')[4] = '9999', string_split(WND, ',')[4] = '9999' from tmp union all select STATION, 'visibility_m', string_split(VIS, ',')[1] = '999999', string_split(VIS, ',')[1] = '999999' or len(string_split(VIS, ',')) <> 4 from tmp
 union all select STATION, 'precip_period_hours_1', coalesce(string_split(AA1, ',')[1] = '99', false), AA1 is null or string_split(AA1, ',')[1] = '99' from tmp union all select STATION, 'precip_amount_1', coalesce(string_split(AA1, ',')[2] = '9999', false), AA1 is null or string_split(AA1, ',')[2] = '9999' from tmp)
 select STATION, field, count(*) filter (s) as n_raw, count(*) filter (s and z) as n_replaced, count(*) filter (z) as n_null from m group by all""")
def by_metric(spark, sf_dir):
    return summaries.sentinel_alignment(cleaning.clean(obs(spark, sf_dir), keep_raw=True), ["TMP", "WND", "VIS", "AA1"], ["STATION"])


@query("W06_capped_examples", W_PATTERNS + ", f as (select m.pattern, o.STATION, min(o.obs_id) as obs_id from m join obs o using (obs_id) group by m.pattern, o.STATION, o.TMP, o.VIS, o.WND, coalesce(o.AA1, '')) select * from f qualify row_number() over (partition by pattern order by STATION, obs_id) <= 7")
def capped_examples(spark, sf_dir):
    return summaries.examples(obs(spark, sf_dir), "STATION", "obs_id", 7, ("TMP", "VIS", "WND", "AA1")).select("pattern", "STATION", "obs_id")


#: Attributes of stations, each of them unknown on other rows; the last station has no elevation at all.
ATTRIBUTES = """select event_id as obs_id, cast(event_id % 8 as int) as station, case when event_id % 3 = 0 then 40.0 + event_id % 80 end as LATITUDE, case when event_id % 5 = 0 then -100.0 + event_id % 60 end as LONGITUDE,
 case when event_id % 8 < 7 and event_id % 7 = 0 then 1.0 * (event_id % 900) end as ELEVATION from {events}"""


@query("W07_each_attribute", f"with a as ({ATTRIBUTES.format(events='events')}) select station, arg_min(LATITUDE, obs_id) filter (LATITUDE is not null)::double as LATITUDE, arg_min(LONGITUDE, obs_id) filter (LONGITUDE is not null)::double as LONGITUDE, arg_min(ELEVATION, obs_id) filter (ELEVATION is not null)::double as ELEVATION from a group by station")
def each_attribute(spark, sf_dir):
    df = spark.sql(ATTRIBUTES, events=spark.read.parquet(f"{sf_dir}/events.parquet"))
    return summaries.first_known(df, ["station"], "obs_id", ["LATITUDE", "LONGITUDE", "ELEVATION"]).withColumns({c: F.col(c).cast("double") for c in ("LATITUDE", "LONGITUDE", "ELEVATION")})


@query("J10_stale_paths", """select p_partkey as file_name, case when p_partkey % 4 = 0 or p_partkey % 3 = 0 then '/data/' || p_partkey when p_partkey % 5 = 0 or p_partkey % 2 = 1 then '/old/' || p_partkey else '/data/' || p_partkey end as path,
 case when p_partkey % 4 = 0 then 'unexpected' when p_partkey % 3 = 0 then case when p_partkey % 2 = 0 then 'present' else 'missing' end when p_partkey % 5 = 0 then 'present' when p_partkey % 2 = 0 then 'stale' else 'missing' end as state from part""")
def stale_paths(spark, sf_dir):
    """Every fourth file isn't pulled, every third has no path in its state; the old folder has every fifth file, the new one the even ones."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("file_name"))
    at = lambda folder: F.concat(F.lit(folder), F.col("file_name").cast("string"))
    k = F.col("file_name")
    state = p.select("file_name", (k % 4 != 0).alias("pulled"), F.when(k % 3 == 0, " ").otherwise(at("/old/")).alias("raw_path"), at("/data/").alias("default_path"))
    files = p.where("file_name % 5 = 0").select(at("/old/").alias("path")).unionAll(p.where("file_name % 2 = 0").select(at("/data/").alias("path")))
    return summaries.sync(state, files)


@query("J09_metadata_rows", """with f as (select s_suppkey % 40 as station, 1990 + s_suppkey % 23 as year from supplier), y as (select station, count(distinct year) as no_of_years, min(year) filter (year between 1995 and 2005) as first_year, max(year) filter (year between 1995 and 2005) as last_year, count(*) filter (year between 1995 and 2005) as year_count from f group by station)
 select n_nationkey as station, n_name as NAME, no_of_years, first_year, last_year, year_count, n_nationkey % 4 <> 0 as metadata_complete from nation left join y on n_nationkey = station""")
def metadata_rows(spark, sf_dir):
    files = spark.read.parquet(f"{sf_dir}/supplier.parquet").select((F.col("s_suppkey") % 40).alias("station"), (F.col("s_suppkey") % 23 + 1990).alias("year"))
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("station"), F.col("n_name").alias("NAME"), F.lit(1.0).alias("LATITUDE"), F.lit(2.0).alias("LONGITUDE"), F.when(F.col("n_nationkey") % 4 != 0, 3.0).alias("ELEVATION"))
    return summaries.station_rows(files, n, "station", "year", 1995, 2005).drop("LATITUDE", "LONGITUDE", "ELEVATION")


@query("G21_usable_rows", W_USE + """, d as (select STATION, 'temperature' as domain, temperature_c is not null as ok, 'domain_splits' as mode from tmp where STATION < '00000000005' union all select STATION, 'wind', string_split(WND, ',')[1] <> '999' or string_split(WND, ',')[4] <> '9999', 'domain_splits' from tmp where STATION < '00000000005'
 union all select STATION, 'remarks', obs_id % 4 > 1, 'domain_splits' from tmp where STATION < '00000000003' union all select STATION, '__all__', n > 0, 'fallback_no_domain_splits' from u where STATION >= '00000000005')
 select STATION, domain, count(*) as rows_total, count(*) filter (ok) as usable_rows, round(count(*) filter (ok) / count(*), 6) as usable_row_rate, mode as artifact_mode from d group by all""")
def usable_rows(spark, sf_dir):
    """One domain by the mark of usable rows, one by its numbers, one of texts alone; stations without domains as a whole."""
    raw = obs(spark, sf_dir)
    some = raw.where("STATION < '00000000005'")
    domains = {
        "temperature": cleaning.clean(some.select("STATION", "TMP")),
        "wind": cleaning.clean(some.select("STATION", "WND")).select("STATION", "wind_direction_deg", "wind_speed_ms"),
        "remarks": raw.where("STATION < '00000000003'").select("STATION", "DATE", F.expr("case obs_id % 4 when 0 then null when 1 then ' ' else 'SYN' end").alias("REM")),
    }
    return rounded(summaries.usable_rows(domains, cleaning.clean(raw), "STATION"), "usable_row_rate", to=6)


RANK = "select '{0}' as section, row_number() over (order by {1} desc, {2}) as place, station, {3} as year, round({4} / n, 6) as rate, {4} as n, n as rows_total from {5} qualify place <= 10"


@query("G47_structural_and_substantive", W_LINES + """, p as (select cast(e % 12 as integer) as station, cast(2000 + e % 5 as integer) as year, header_error is not null or e % 53 = 0 as bad, e % 10 = 0 as s from h),
 q as (select station, count(*) as n, count(*) filter (bad) as b, count(*) filter (not bad and s) as f from p group by station), y as (select station, year, count(*) as n, count(*) filter (not bad and s) as f from p group by station, year) """
 + " union all ".join([f"({RANK.format('structural', 'b / n', 'station', 'null::integer', 'b', 'q')})", f"({RANK.format('substantive', 'f / n', 'station', 'null::integer', 'f', 'q')})", f"({RANK.format('station_years', 'f', 'station, year', 'year', 'f', 'y')})"]))
def structural_and_substantive(spark, sf_dir):
    """Records with faults are structural impacts; every tenth temperature is missing."""
    k = F.col("obs_id")
    df = lines(spark, sf_dir).withColumns({"TMP": F.when(k % 10 == 0, "+9999,9").otherwise(F.col("TMP")), "station": (k % 12).cast("int"), "year": (k % 5 + 2000).cast("int")})
    x = cleaning.clean(df)
    p = profiles.full_profile(x, ["TMP"], ["station"], compat=False)
    return rounded(summaries.impact_leaders(p, "station", cleaning.profile(x, ["station", "year"], compat=False)), "rate", to=6)
