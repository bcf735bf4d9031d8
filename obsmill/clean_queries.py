"""Registered queries on whole-table cleaning, control fields, views and profiles, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsmill.functions.units import add_units
from obsmill.operators import cleaning, climate, fleet
from obsmill.queries import W_TMP, W_USE, obs, query, rounded, station_years

#: Fixed-width records from events: sound ones and each fault of a header.
LINES = """select event_id as obs_id, case when event_id % 3 = 0 then '+0180,1' else '-0020,1' end as TMP, case when event_id % 47 = 0 then substr(line, 1, 40) when event_id % 53 = 0 then line || 'x' else line end as raw_line from
 (select event_id, lpad(cast(event_id % 60 as {text}), 4, '0') || lpad(cast(event_id % 1000000 as {text}), 6, '0') || '99999' || case when event_id % 13 = 0 then '20230229' else '202402' || lpad(cast(1 + event_id % 29 as {text}), 2, '0') end
  || case when event_id % 17 = 0 then '2460' else lpad(cast(event_id % 24 as {text}), 2, '0') || '00' end || case when event_id % 19 = 0 then 'Z' else '4' end
  || case when event_id % 23 = 0 then '-99999' when event_id % 29 = 0 then '+91000' when event_id % 31 = 0 then '+4x000' else '+' || lpad(cast(event_id % 90000 as {text}), 5, '0') end
  || case when event_id % 37 = 0 then '+999999' else '-' || lpad(cast(event_id % 170000 as {text}), 6, '0') end || '+0' || lpad(cast(event_id % 1000 as {text}), 3, '0')
  || case when event_id % 41 = 0 then 'XXXXX' else 'FM-12' end || '99999' || case when event_id % 43 = 0 then 'V04 ' else 'V02 ' end || rpad('', cast(45 + event_id % 60 as integer), 'x') as line from {events})"""
W_LINES = f"""with l as ({LINES.format(text='varchar', events='events')}), k as (select l.*, obs_id as e from l), h as (select k.*, case when e % 47 = 0 then 'control_header_short' when e % 23 = 0 then 'control_header_invalid_sentinel'
 when e % 31 = 0 and e % 29 <> 0 then 'control_header_invalid_width' when e % 13 = 0 or e % 17 = 0 or e % 19 = 0 or e % 29 = 0 or e % 41 = 0 or e % 43 = 0 then 'control_header_invalid_domain' end as header_error from k)"""


def lines(spark, sf_dir):
    return spark.sql(LINES.format(text="string", events="{events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))


@query("V26_control_header", W_LINES + " select obs_id, header_error from h")
def control_header(spark, sf_dir):
    return lines(spark, sf_dir).select("obs_id", cleaning.header_error(F.col("raw_line")).alias("header_error"))


@query("V27_rejected_rows", W_LINES + " select obs_id, case when header_error is not null then 'header' when e % 53 = 0 then 'structure' else 'none' end as kind, case when header_error is null and e % 53 <> 0 then case when e % 3 = 0 then 18.0::double else -2.0::double end end as temperature_c, header_error is null and e % 53 <> 0 as usable from h")
def rejected_rows(spark, sf_dir):
    x = cleaning.clean(lines(spark, sf_dir))
    kind = F.when(F.col("__parse_error").isNull(), "none").when(F.col("__parse_error").startswith("control_header"), "header").otherwise("structure")
    return x.select("obs_id", kind.alias("kind"), F.round("temperature_c", 6).alias("temperature_c"), F.col("row_has_any_usable_metric").alias("usable"))


CONTROLS = """select event_id as obs_id, case event_id % 4 when 0 then '+12345' when 1 then '012345' when 2 then '91.5' else '99999' end as LATITUDE, case event_id % 3 when 0 then '-0012345' when 1 then '-012345' else '12.25' end as LONGITUDE,
 case event_id % 5 when 0 then '+0100' when 1 then '9999' when 2 then '+9000' when 3 then '12.5' else null end as ELEVATION, case event_id % 2 when 0 then '20240229' else '2024-01-01T00:00:00' end as DATE,
 case event_id % 5 when 0 then '2500' else '1230' end as TIME, case event_id % 3 when 0 then 'OEDW ' when 1 then '99999' else 'ABC' end as CALL_SIGN, case event_id % 3 when 0 then '4' when 1 then '9' else 'z' end as SOURCE,
 case event_id % 3 when 0 then 'fm-12' when 1 then 'XXXXX' else 'SAO' end as REPORT_TYPE, case event_id % 2 when 0 then 'v02' else 'V020' end as QUALITY_CONTROL, 'ADD' as ADD from {events}"""
W_CONTROLS = f"with c as ({CONTROLS.format(events='events')})"


def controls(spark, sf_dir):
    return spark.sql(CONTROLS, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


@query("V28_normal_control", W_CONTROLS + """ select obs_id, case when obs_id % 4 in (0, 1) then 12.345::double end as LATITUDE, case obs_id % 3 when 1 then -12.345::double when 2 then 12.25::double end as LONGITUDE, case obs_id % 5 when 0 then 100.0::double when 3 then 12.5::double end as ELEVATION,
 case when obs_id % 2 = 0 then '20240229' end as DATE, case when obs_id % 5 <> 0 then '1230' end as TIME, case when obs_id % 3 = 0 then 'OEDW' end as CALL_SIGN, case when obs_id % 3 = 0 then '4' end as SOURCE, case when obs_id % 3 = 0 then 'FM-12' end as REPORT_TYPE,
 case when obs_id % 2 = 0 then 'V02' end as QUALITY_CONTROL from c""")
def normal_control(spark, sf_dir):
    df = controls(spark, sf_dir)
    return rounded(df.select("obs_id", *[c.alias(k) for k, c in cleaning.normal_control(df).items()]), "LATITUDE", "LONGITUDE", "ELEVATION", to=6)


@query("V29_control_flags", W_CONTROLS + """ select obs_id, obs_id % 4 in (2, 3) as latitude, obs_id % 2 = 1 as date_, obs_id % 5 in (1, 2) as elevation, obs_id % 3 <> 0 as source,
 obs_id % 4 in (2, 3) or obs_id % 3 = 0 or obs_id % 2 = 1 or obs_id % 5 in (0, 1, 2) or obs_id % 3 <> 0 as any_invalid from c""")
def control_flags(spark, sf_dir):
    x = cleaning.control_flags(controls(spark, sf_dir))
    flag = lambda c: F.col(f"qc_control_invalid_{c}")
    return x.select("obs_id", flag("latitude").alias("latitude"), flag("date").alias("date_"), flag("elevation").alias("elevation"), flag("source").alias("source"), F.col("qc_domain_invalid_CONTROL").alias("any_invalid"))


@query("V30_marker", W_CONTROLS + " select count(*) as n, true as dropped_constant, false as dropped_other from c")
def marker(spark, sf_dir):
    df = controls(spark, sf_dir)
    other = df.withColumn("ADD", F.when(F.col("obs_id") > 0, "AA1"))
    made = [F.lit("ADD" not in cleaning.drop_marker(x).columns) for x in (df, other)]
    return cleaning.drop_marker(df).agg(F.count("*").alias("n")).select("n", made[0].alias("dropped_constant"), made[1].alias("dropped_other"))


@query("V34_readable_names", W_TMP + " select obs_id, round(temperature_c, 6) as temperature_c, pass as TMP__qc_pass, reason as TMP__qc_reason, q as TMP__quality from tmp")
def readable_names(spark, sf_dir):
    x = cleaning.clean(obs(spark, sf_dir))
    return rounded(x.select("obs_id", "temperature_c", "TMP__qc_pass", "TMP__qc_reason", "TMP__quality"), "temperature_c", to=6)


@query("V35_permissive", W_TMP + " select obs_id, false as strict, round(case when not sent and num is not null and q not in ('8') and num between -932 and 618 then num * 0.1 end, 6) as temperature_c from tmp")
def permissive(spark, sf_dir):
    x, strict = cleaning.clean_or_permit(obs(spark, sf_dir).withColumn("DATE", F.col("DATE").cast("string")))
    return rounded(x.select("obs_id", F.lit(strict).alias("strict"), "temperature_c"), "temperature_c", to=6)


@query("V37_contract", "select 'DATE' as \"column\", 'missing' as fault, null::bigint as n union all select 'YEAR', 'type', count(*) from customer where c_custkey % 7 = 0")
def contract(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    df = c.select(F.col("c_name").alias("STATION"), F.when(F.col("c_custkey") % 7 == 0, "y2k").otherwise("2000").alias("YEAR"), F.lit(True).alias("row_has_any_usable_metric"), F.lit(1).alias("usable_metric_count"), F.lit(0.5).alias("usable_metric_fraction"))
    return cleaning.contract_faults(df)


WHEN = """select event_id as obs_id, case event_id % 4 when 0 then '202401' || lpad(cast(1 + event_id % 28 as {text}), 2, '0') when 1 then '2024-01-05T06:30:00' when 2 then 'soon' else '2024-03-01' end as DATE,
 case event_id % 5 when 0 then '2460' when 1 then '06' else lpad(cast(event_id % 24 as {text}), 2, '0') || '15' end as TIME, case when event_id % 6 = 0 then '2023-12-31 00:00:00' end as DATE_PARSED from {events}"""


@query("V38_text_times", f"with w as ({WHEN.format(text='varchar', events='events')})" + """, t as (select obs_id, case obs_id % 4 when 0 then strptime(DATE, '%Y%m%d') when 1 then timestamp '2024-01-05 06:30:00' when 3 then timestamp '2024-03-01' when 2 then case when obs_id % 6 = 0 then timestamp '2023-12-31' end end as d, TIME,
 obs_id % 5 >= 2 as ok from w), u as (select obs_id, case when ok and hour(d) = 0 and minute(d) = 0 then d + to_hours(cast(substr(TIME, 1, 2) as integer)) + to_minutes(15) else d end as d from t where d is not null)
 select obs_id, d as DATE, cast(year(d) as integer) as year, cast(month(d) as integer) as month, cast(d as date) as day, cast(hour(d) as integer) as hour from u""")
def text_times(spark, sf_dir):
    df = spark.sql(WHEN.format(text="string", events="{events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))
    return climate.text_times(df).select("obs_id", "DATE", "year", "month", "day", "hour")


@query("V39_wind_view", W_TMP + """, p as (select *, string_split(WND, ',') as w from obs) select STATION as station_id, cast(obs_id as bigint) as obs_id, round(case when w[4] <> '9999' then cast(w[4] as double) * 0.1 end, 6) as wind_speed_ms,
 case when w[1] <> '999' then cast(w[1] as double) end as wind_direction_deg, case when w[3] <> '9' then w[3] end as wind_type_code, w[4] <> '9999' as WND__part4__qc_pass from p""")
def wind_view(spark, sf_dir):
    x = cleaning.with_contract(cleaning.clean(obs(spark, sf_dir)))
    made = cleaning.view(x.withColumn("DATE", F.col("obs_id")), "wind")
    return rounded(made.withColumnRenamed("DATE", "obs_id"), "wind_speed_ms", to=6)


@query("V39_temperature_view", W_TMP + " select STATION as station_id, DATE, round(temperature_c, 6) as temperature_c, pass as TMP__qc_pass from tmp")
def temperature_view(spark, sf_dir):
    return rounded(cleaning.view(cleaning.with_contract(cleaning.clean(obs(spark, sf_dir))), "pressure_temperature"), "temperature_c", to=6)


@query("V41_wind_units", W_TMP + """ select obs_id, round(s * 1.9438444924, 9) as wind_speed_ms_kt, round(s * 2.2369362921, 9) as wind_speed_ms_mph, round(s * 2.2369362921, 9) as wind_speed_ms_mph__daily_max, s as wave_height_m
 from (select obs_id, case when string_split(WND, ',')[4] <> '9999' then cast(string_split(WND, ',')[4] as double) * 0.1 end as s from obs)""")
def wind_units(spark, sf_dir):
    x = cleaning.clean(obs(spark, sf_dir)).select("obs_id", "wind_speed_ms", F.col("wind_speed_ms").alias("wind_speed_ms__daily_max"), F.col("wind_speed_ms").alias("wave_height_m"))
    return rounded(add_units(x).drop("wind_speed_ms", "wind_speed_ms__daily_max", "wind_speed_ms_kt__daily_max"), "wind_speed_ms_kt", "wind_speed_ms_mph", "wind_speed_ms_mph__daily_max")


FILES = """select p_partkey as id, case p_partkey % 5 when 0 then '723150-03812-' || cast(2000 + p_partkey % 20 as {text}) when 1 then 'archive/723150-03812.csv' when 2 then '' else ' 72315003812.CSV ' end as file_name,
 case p_partkey % 3 when 0 then cast(p_partkey as {text}) || '.0' when 1 then cast(p_partkey as {text}) else 'ABC' end as station, case p_partkey % 4 when 0 then ' True' when 1 then 'y' when 2 then 'no' else null end as pulled from {part}"""


@query("V44_registry", f"with f as ({FILES.format(text='varchar', part='part')})" + " select id, case when id % 5 <> 2 then '72315003812' when id % 3 = 2 then 'ABC' else lpad(cast(id as varchar), 11, '0') end as station_id, id % 4 in (0, 1) as pulled from f")
def registry(spark, sf_dir):
    df = spark.sql(FILES.format(text="string", part="{part}"), part=spark.read.parquet(f"{sf_dir}/part.parquet"))
    return df.select("id", fleet.station_id(F.col("file_name"), F.col("station")).alias("station_id"), fleet.truthy(F.col("pulled")).alias("pulled"))


W_PATTERNS = W_TMP + """, p as (select *, string_split(WND, ',') as w, string_split(VIS, ',')[1] as v, string_split(AA1, ',') as a from tmp),
 b as (select *, tok not in ('+9999', '-9999') as tv, v <> '999999' as vv, w[4] <> '9999' as sv from p),
 m as (select obs_id, 'tmp_missing_sentinel' as pattern from b where tok = '+9999' union all select obs_id, 'tmp_negative_sentinel' from b where tok = '-9999' union all select obs_id, 'vis_missing_sentinel' from b where v = '999999'
 union all select obs_id, 'wnd_calm_valid' from b where w[1] = '000' and w[4] = '0000' union all select obs_id, 'wnd_missing_dir_valid_spd' from b where w[1] = '999' and sv union all select obs_id, 'wnd_fully_missing' from b where w[1] = '999' and w[4] = '9999'
 union all select obs_id, 'aa1_valid_precip' from b where a[1] <> '99' and a[2] <> '9999' union all select obs_id, 'aa1_missing_sentinel' from b where a[2] = '9999'
 union all select obs_id, 'mixed_validity' from b where ((tv and num is not null) or vv or sv) and (tok in ('+9999', '-9999') or v = '999999' or w[4] = '9999') union all select obs_id, 'multi_family_informative' from b where tok <> '' and v <> '' and w[1] <> '' and a[1] <> '')"""


@query("V45_patterns", W_PATTERNS + " select obs_id, pattern from m")
def patterns(spark, sf_dir):
    return fleet.matches(obs(spark, sf_dir)).select("obs_id", "pattern")


@query("G48_pattern_totals", W_PATTERNS + " select pattern, count(*) as n from m group by pattern")
def pattern_totals(spark, sf_dir):
    return fleet.matches(obs(spark, sf_dir)).groupBy("pattern").agg(F.count("*").alias("n"))


W_VERDICTS = W_TMP + """, vd as (select tmp.obs_id, tmp.STATION, unnest([{identifier: 'TMP', reason: reason}, {identifier: 'WND', reason: case when string_split(WND, ',')[1] = '999' then 'SENTINEL_MISSING' end}, {identifier: 'WND', reason: case when string_split(WND, ',')[4] = '9999' then 'SENTINEL_MISSING' end},
 {identifier: 'VIS', reason: case when string_split(VIS, ',')[1] = '999999' then 'SENTINEL_MISSING' end}, {identifier: 'AA1', reason: case when string_split(AA1, ',')[1] = '99' then 'SENTINEL_MISSING' end}, {identifier: 'AA1', reason: case when string_split(AA1, ',')[2] = '9999' then 'SENTINEL_MISSING' end}]) as x from tmp)"""


@query("G15_quality_profile", W_VERDICTS + """, r as (select obs_id, STATION, bool_or(coalesce(x.reason = 'SENTINEL_MISSING', false)) as s, bool_or(coalesce(x.reason = 'BAD_QUALITY_CODE', false)) as b, bool_or(coalesce(x.reason in ('OUT_OF_RANGE', 'MALFORMED_TOKEN'), false)) as o from vd group by all)
 select STATION, count(*) as rows_total, count(*) filter (s or b or o) as rows_with_qc_flags, 0::bigint as rows_with_structural_impacts, count(*) filter (s) as rows_with_sentinel_impacts, count(*) filter (b) as rows_with_quality_code_impacts, count(*) filter (o) as rows_with_other_substantive_impacts,
  round(count(*) filter (s or b or o) / count(*), 6) as fraction_rows_impacted from r group by STATION""")
def quality_profile(spark, sf_dir):
    return rounded(cleaning.profile(cleaning.clean(obs(spark, sf_dir)), ["STATION"], compat=False), "fraction_rows_impacted", to=6)


@query("G36_trigger_counts", W_VERDICTS + """ select x.identifier, case x.reason when 'SENTINEL_MISSING' then 'sentinel_handling' when 'BAD_QUALITY_CODE' then 'quality_code_handling' when 'OUT_OF_RANGE' then 'range_validation' else 'width_validation' end as family, count(*) as n from vd where x.reason is not null group by all""")
def trigger_counts(spark, sf_dir):
    return cleaning.trigger_counts(cleaning.clean(obs(spark, sf_dir)))


@query("G37_family_impact", W_VERDICTS + """, f as (select case x.reason when 'SENTINEL_MISSING' then 'sentinel_handling' when 'BAD_QUALITY_CODE' then 'quality_code_handling' when 'OUT_OF_RANGE' then 'range_validation' else 'width_validation' end as family, count(*) as n from vd where x.reason is not null group by all)
 select family, n, round(n / (select count(*) * 6 from tmp), 9) as share_of_cells, round(n / (select sum(n) from f), 9) as share_of_impacts from f""")
def family_impact(spark, sf_dir):
    x = cleaning.clean(obs(spark, sf_dir))
    cells = x.count() * sum(c.endswith("__qc_pass") for c in x.columns)
    f = cleaning.trigger_counts(x).groupBy("family").agg(F.sum("n").alias("n"))
    whole = f.agg(F.sum("n")).first()[0] or 1
    return f.select("family", "n", F.round(F.col("n") / cells, 9).alias("share_of_cells"), F.round(F.col("n") / whole, 9).alias("share_of_impacts"))


@query("G34_flag_counts", W_TMP + " select 'qc_calm_wind_detected' as flag, count(*) filter (string_split(WND, ',')[3] = '9' and string_split(WND, ',')[4] = '0000') as n from obs union all select 'qc_control_invalid_date', count(*) from obs union all select 'qc_domain_invalid_CONTROL', count(*) from obs")
def flag_counts(spark, sf_dir):
    return cleaning.flag_counts(cleaning.clean(obs(spark, sf_dir)))


@query("G30_domain_report", W_TMP + """, d as (select STATION, 'temperature' as domain, temperature_c is not null as x, (temperature_c is null)::integer as k, 1 as w from tmp
 union all select STATION, 'wind', string_split(WND, ',')[1] <> '999' or string_split(WND, ',')[4] <> '9999', (string_split(WND, ',')[1] = '999')::integer + (string_split(WND, ',')[4] = '9999')::integer, 2 from tmp)
 select STATION, domain, count(*) as n_rows, count(*) filter (x) as n_any, round(count(*) filter (x) / count(*), 6) as fraction_any, sum(k)::bigint as n_null, round(sum(k) / sum(w), 6) as null_fraction from d group by all""")
def domain_report(spark, sf_dir):
    x = cleaning.clean(obs(spark, sf_dir))
    return rounded(cleaning.class_report(x, ["temperature_c", "wind_direction_deg", "wind_speed_ms"], ["STATION"]), "fraction_any", "null_fraction", to=6)


@query("J14_strict_losses", W_TMP + " select count(*) as n_rows, count(*) filter (wid and not sent and num is not null and not coalesce(q in ('8'), false) and num between -932 and 618) as newly_null from tmp")
def strict_losses(spark, sf_dir):
    df = obs(spark, sf_dir)
    loose = cleaning.clean(df, strict=False).select("obs_id", F.col("temperature_c").alias("loose"))
    both = cleaning.clean(df).select("obs_id", "temperature_c").join(loose, "obs_id")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("temperature_c").isNull() & F.col("loose").isNotNull()).alias("newly_null"))


#: Cells with as many tokens as their families have, too few, too many, and the value alone.
CELLS = """select event_id as obs_id, cast(cast(20240101 + event_id % 28 as int) as {text}) as DATE, case event_id % 4 when 1 then '010000,1,N' when 2 then '010000,1,N,1,9' when 3 then '010000' else '010000,1,N,1' end as VIS,
 case event_id % 4 when 1 then '10132,1' when 2 then '10132,1,09876,1,5' when 3 then '10132' else '10132,1,09876,1' end as MA1, case event_id % 4 when 1 then '015,0123' when 2 then '015,0123,1,051010,1,7' when 3 then '015' else '015,0123,1,051010,1' end as AH1,
 case event_id % 4 when 1 then '+0180' when 2 then '+0180,1,7' when 3 then '+180,1' else '+0180,1' end as TMP from {events}"""


def cells(spark, sf_dir):
    return spark.sql(CELLS.format(text="string", events="{events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))


@query("V16_short_and_long", """with c as (select event_id as obs_id, event_id % 4 as k from events)
 select obs_id, case when k = 0 then 10000.0::double end as vis_strict, 10000.0::double as vis, case when k in (0, 2) then 'N' when k = 1 then 'N' end as vis_code, case when k = 0 then 1013.2::double end as altimeter_strict, 1013.2::double as altimeter, case when k in (0, 2) then 987.6::double end as pressure,
  case when k in (0, 2) then true end as pressure_pass, 15.0::double as period_strict, case when k <> 3 then 12.3::double end as depth_strict, case when k <> 3 then 12.3::double end as depth, k <> 0 as mismatch, case when k = 0 then 18.0::double end as temperature_strict, 18.0::double as temperature from c""")
def short_and_long(spark, sf_dir):
    df = cells(spark, sf_dir)
    s = cleaning.clean(df).select("obs_id", *[F.col(c).alias(f"s_{c}") for c in ("visibility_m", "altimeter_setting_hpa", "AH1__part1", "AH1__part2", "temperature_c", "qc_arity_mismatch_AH1")])
    x = cleaning.clean(df, strict=False).join(s, "obs_id")
    value = lambda c: F.round(c, 6)
    return x.select(
        "obs_id", value("s_visibility_m").alias("vis_strict"), value("visibility_m").alias("vis"), F.col("visibility_variability").alias("vis_code"), value("s_altimeter_setting_hpa").alias("altimeter_strict"), value("altimeter_setting_hpa").alias("altimeter"),
        value("station_pressure_hpa").alias("pressure"), F.col("MA1__part3__qc_pass").alias("pressure_pass"), value("s_AH1__part1").alias("period_strict"), value("s_AH1__part2").alias("depth_strict"), value("AH1__part2").alias("depth"),
        F.col("s_qc_arity_mismatch_AH1").alias("mismatch"), value("s_temperature_c").alias("temperature_strict"), value("temperature_c").alias("temperature"))


@query("V35_retry", "select obs_id, true as eight_digits, false as iso, false as unreadable, case when obs_id % 4 = 0 then 18.0::double end as temperature_strict, 18.0::double as temperature from (select event_id as obs_id from events)")
def retry(spark, sf_dir):
    """Cleaned strictly with dates of eight digits, permissively with ISO ones and where no date can be read."""
    df = cells(spark, sf_dir)
    made = {"eight_digits": df, "iso": df.withColumn("DATE", F.lit("2024-01-05T06:30:00")), "unreadable": df.withColumn("DATE", F.lit("soon"))}
    out = {k: cleaning.clean_or_permit(x) for k, x in made.items()}
    loose = out["unreadable"][0].select("obs_id", F.round("temperature_c", 6).alias("temperature"))
    return out["eight_digits"][0].select("obs_id", *[F.lit(s).alias(k) for k, (_, s) in out.items()], F.round("temperature_c", 6).alias("temperature_strict")).join(loose, "obs_id")


@query("J14_losses_by_field", """with n as (select count(*) as n, count(*) filter (event_id % 4 = 0) as k0, count(*) filter (event_id % 4 <> 3) as k3, count(*) filter (event_id % 4 in (0, 2)) as k2 from events)
 select 'temperature_c' as field, n as n_permissive, n - k0 as newly_null, round((n - k0) / n, 9) as rate from n union all select 'visibility_m', n, n - k0, round((n - k0) / n, 9) from n union all select 'visibility_variability', k3, k3 - k0, round((k3 - k0) / k3, 9) from n
 union all select 'altimeter_setting_hpa', n, n - k0, round((n - k0) / n, 9) from n union all select 'station_pressure_hpa', k2, k2 - k0, round((k2 - k0) / k2, 9) from n""")
def losses_by_field(spark, sf_dir):
    out = cleaning.strict_losses(cells(spark, sf_dir), ["TMP", "VIS", "MA1"])
    return rounded(out.where(F.col("field").isin("temperature_c", "visibility_m", "visibility_variability", "altimeter_setting_hpa", "station_pressure_hpa")), "rate")


@query("G47_impact_leaders", W_USE + " select STATION, n_lost from (select STATION, count(*) filter (n < 4) as n_lost from u group by STATION) order by n_lost desc, STATION limit 5")
def impact_leaders(spark, sf_dir):
    return station_years(spark, sf_dir).groupBy("STATION").agg(F.sum("n_lost").alias("n_lost")).orderBy(F.desc("n_lost"), "STATION").limit(5)


@query("O04_seeded_pick", "select 1::bigint as n_picked, true as again_the_same, c.n as n_known from (select count(*) as n from customer) as c")
def seeded_pick(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("station_id"))
    one, again = fleet.pick(c, "station_id", 7), fleet.pick(c, "station_id", 7).withColumnRenamed("station_id", "other")
    same = one.join(again, F.col("station_id") == F.col("other")).agg(F.count("*").alias("n_picked"), F.bool_and(F.col("station_id") == F.col("other")).alias("again_the_same"))
    return same.crossJoin(c.agg(F.count("*").alias("n_known")))
