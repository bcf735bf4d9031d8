"""Registered queries on the rules of single families, over cells that reach every branch, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsmill.functions import decode as d
from obsmill.functions import identifiers
from obsmill.plans.rules import TABLES
from obsmill.queries import query, rounded

#: Coded cells from events: sound ones and each kind of fault, by arithmetic on the id.
CELLS = """select event_id as obs_id, lpad(cast(user_id % 20 as {text}), 11, '0') as STATION,
 case when event_id % 7 = 0 then '99999,9,10132,1' when event_id % 11 = 0 then '10132,8,09990,1' when event_id % 13 = 0 then '1013,1,09990,1' when event_id % 17 = 0 then '08000,1,12000,1'
  else '1' || lpad(cast(event_id % 900 as {text}), 4, '0') || ',1,09' || lpad(cast(event_id % 1000 as {text}), 3, '0') || ',' || cast(event_id % 10 as {text}) end as MA1,
 case when event_id % 5 = 0 then '9,1,010,1,+0010,1' when event_id % 7 = 0 then '3,1,01,1,+0010,1' when event_id % 11 = 0 then '3,1,0x0,1,0010,1' when event_id % 13 = 0 then '3,5,010,1,+0010,4'
  else cast(event_id % 9 as {text}) || ',1,' || lpad(cast(event_id % 600 as {text}), 3, '0') || ',1,' || case when event_id % 2 = 0 then '+' else '-' end || lpad(cast(event_id % 1000 as {text}), 4, '0') || ',1' end as MD1,
 lpad(cast(event_id % 20 as {text}), 2, '0') || ',' || lpad(cast(event_id % 600 as {text}), 3, '0') || ',' || lpad(cast(event_id % 400 as {text}), 3, '0') || ',' || cast(event_id % 5 as {text}) as UG1,
 cast(event_id % 6 as {text}) || ',' || case event_id % 3 when 0 then 'C' when 1 then 'i' else 'X' end || ',' || case when event_id % 10 = 0 then 'C' else '1' end as AC1,
 case when event_id % 9 = 0 then '045,0100,1,010203' else lpad(cast(event_id % 60 as {text}), 3, '0') || ',0100,' || cast(event_id % 4 as {text}) || ',' || case when event_id % 5 = 0 then '320000' else '011230' end || ',1' end as AH1,
 lpad(cast(event_id % 70 as {text}), 2, '0') || ',0' || lpad(cast(event_id % 1000 as {text}), 4, '0') || ',' || case event_id % 4 when 0 then '9' when 1 then '2' else '1' end || ',0' as CB1,
 lpad(cast(event_id % 100 as {text}), 2, '0') || ',' || case when event_id % 10 = 8 then '8' else '1' end as MW1,
 '000180,' || cast(event_id % 9 as {text}) || ',' || case event_id % 3 when 0 then 'APOSLP' when 1 then 'PRSWM9' else 'prcp' end as Q01,
 case when event_id % 6 = 0 then '1,24,999,0000,1' else '1,' || lpad(cast(event_id % 60 as {text}), 2, '0') || ',' || lpad(cast(event_id % 400 as {text}), 3, '0') || ',' || lpad(cast(event_id % 2100 as {text}), 4, '0') || ',1' end as OD1,
 case event_id % 4 when 0 then '+0250,4' when 1 then '0250,1' when 2 then '250,1' else '-0' || lpad(cast(event_id % 100 as {text}), 3, '0') || ',2' end as SA1,
 case when event_id % 3 = 0 then '+100,1,1,000100,1,1' when event_id % 5 = 0 then '9999,9,1,999999,9,1' else lpad(cast(event_id % 1300 as {text}), 4, '0') || ',E,1,000100,1,C' end as AJ1
from {events}"""
W = f"with c as ({CELLS.format(text='varchar', events='events')})"


def part(column: str, n: int) -> str:
    return f"string_split({column}, ',')[{n}]"


def cells(spark, sf_dir):
    return spark.sql(CELLS.format(text="string", events="{events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))


@query("V05_code_tables", W + f", t(code) as (values {', '.join(f'({x!r})' for x in TABLES['automated_weather'])}) select obs_id, {part('MW1', 1)} as token, exists (select 1 from t where code = {part('c.MW1', 1)}) as known from c")
def code_tables(spark, sf_dir):
    table = spark.createDataFrame([(x,) for x in TABLES["automated_weather"]], "code string")
    df = cells(spark, sf_dir).select("obs_id", d.token(F.col("MW1"), 1).alias("token"))
    return df.join(F.broadcast(table), F.col("token") == F.col("code"), "left").select("obs_id", "token", F.col("code").isNotNull().alias("known"))


@query("V07_quality_parts", W + f""" select obs_id, case when {part('MA1', 2)} in ('0','1','2','3','4','5','6','7','9','M') then {part('MA1', 2)} end as q2, case when {part('MA1', 4)} in ('0','1','2','3','4','5','6','7','9','M') then {part('MA1', 4)} end as q4 from c""")
def quality_parts(spark, sf_dir):
    return d.decode(cells(spark, sf_dir), "MA1").select("obs_id", "ma1_.q2", "ma1_.q4")


@query("V08_width_pattern", W + f""", x as (select obs_id, {part('MD1', 3)} as a, {part('MD1', 4)} as qa, {part('MD1', 5)} as b, {part('MD1', 6)} as qb from c),
 y as (select *, try_cast(a as double) as an, cast(b as double) as bn from x)
 select obs_id, case when length(a) <> 3 or an is null then 'MALFORMED_TOKEN' when an > 500 then 'OUT_OF_RANGE' end as change_3h, round(case when length(a) = 3 and an <= 500 then an * 0.1 end, 6) as value_3h,
  case when qb not in ('0','1','2','3','9') then 'BAD_QUALITY_CODE' when abs(bn) = 999 and bn > 0 then 'SENTINEL_MISSING' when abs(bn) > 800 then 'OUT_OF_RANGE' end as change_24h from y""")
def width_pattern(spark, sf_dir):
    x = d.decode(cells(spark, sf_dir), "MD1")
    return x.select("obs_id", F.col("md1_.pressure_change_3hr_hpa_qc.reason").alias("change_3h"), F.round("md1_.pressure_change_3hr_hpa", 6).alias("value_3h"), F.col("md1_.pressure_change_24hr_hpa_qc.reason").alias("change_24h"))


@query("V09_implied_width", W + f""" select obs_id, case when {part('AJ1', 1)} not like '+%' and {part('AJ1', 1)} <> '9999' and cast({part('AJ1', 1)} as integer) <= 1200 then cast({part('AJ1', 1)} as double) end as snow_depth,
 case when {part('AJ1', 6)} <> 'C' then {part('AJ1', 6)} end as q6 from c""")
def implied_widths(spark, sf_dir):
    return d.decode(cells(spark, sf_dir), "AJ1").select("obs_id", "aj1_.snow_depth", "aj1_.q6")


@query("V17_flag_only", W + f""", x as (select obs_id, {part('AC1', 1)} as a, upper({part('AC1', 2)}) as b, {part('AC1', 3)} as q, string_split(AH1, ',') as h from c)
 select obs_id, q <> 'C' and (a not in ('0','1','2','3') or b not in ('C','I')) as ac_invalid, case when q <> 'C' then a end as ac_kept,
  len(h) <> 5 as ah_arity, coalesce(h[3] not in ('1','2'), false) as ah_invalid, h[4] = '320000' as ah_pattern from x""")
def flag_only(spark, sf_dir):
    x = d.decode_all(cells(spark, sf_dir), ["AC1", "AH1"])
    return x.select("obs_id", F.col("ac1_.domain_invalid").alias("ac_invalid"), F.col("ac1_.part1").alias("ac_kept"), F.col("ah1_.arity_mismatch").alias("ah_arity"), F.col("ah1_.domain_invalid").alias("ah_invalid"), F.col("ah1_.pattern_mismatch").alias("ah_pattern"))


NAMES = """select p_partkey as id, case p_partkey % 8 when 0 then 'AA' || cast(p_partkey % 7 as {text}) when 1 then 'Q' || lpad(cast(p_partkey % 103 as {text}), 2, '0') when 2 then 'KA0' || cast(p_partkey % 5 as {text}) when 3 then 'WND'
 when 4 then 'CO' || cast(p_partkey % 12 as {text}) when 5 then 'NAME' when 6 then 'GA' || cast(p_partkey % 9 as {text}) else 'N00' end as identifier from {part}"""


@query("V18_identifiers", f"with n as ({NAMES.format(text='varchar', part='part')})" + """ select id, identifier, case when identifier in ('WND', 'CO1') then true when regexp_full_match(identifier, '[QPRCDN][0-9].*') then regexp_full_match(identifier, '[QPRCDN][0-9][0-9]') and substr(identifier, 2) <> '00'
 when identifier like 'AA%' or identifier like 'KA%' then regexp_full_match(identifier, '..[1-4]') when identifier like 'GA%' then regexp_full_match(identifier, '..[1-6]') when identifier like 'CO%' then regexp_full_match(identifier, '..[1-9]') else false end as known from n""")
def identifier_names(spark, sf_dir):
    df = spark.sql(NAMES.format(text="string", part="{part}"), part=spark.read.parquet(f"{sf_dir}/part.parquet"))
    return df.withColumn("known", identifiers.known(F.col("identifier")))


@query("V20_crn_missing", W + f""", x as (select obs_id, {part('CB1', 3)} as q, cast({part('CB1', 2)} as double) as v from c)
 select obs_id, case when q = '2' then 'BAD_QUALITY_CODE' when q = '9' then 'SENTINEL_MISSING' end as reason, round(case when q = '1' then v * 0.1 end, 6) as value from x""")
def crn_missing(spark, sf_dir):
    x = d.decode(cells(spark, sf_dir), "CB1")
    return x.select("obs_id", F.col("cb1_.part2_qc.reason").alias("reason"), F.round("cb1_.part2", 6).alias("value"))


@query("V21_preserved_text", W + f""" select obs_id, case when {part('MW1', 1)} <> '99' and {part('MW1', 2)} <> '8' then {part('MW1', 1)} end as weather, {part('Q01', 1)} as original,
 case when {part('Q01', 2)} <> '8' then {part('Q01', 2)} end as reason_code, case when {part('Q01', 3)} <> 'PRSWM9' then {part('Q01', 3)} end as parameter from c""")
def preserved_text(spark, sf_dir):
    x = d.decode_all(cells(spark, sf_dir), ["MW1", "Q01"])
    return x.select("obs_id", F.col("mw1_.present_weather_manual").alias("weather"), F.col("q01_.original_value").alias("original"), "q01_.reason_code", "q01_.parameter")


@query("V24_residual_sentinels", W + f" select obs_id, case when {part('MD1', 1)} <> '9' and {part('MD1', 2)} <> '5' then {part('MD1', 1)} end as pressure_tendency_code from c")
def residual(spark, sf_dir):
    return d.decode(cells(spark, sf_dir), "MD1").select("obs_id", "md1_.pressure_tendency_code")


@query("V15_swell", W + f""", x as (select obs_id, {part('UG1', 4)} <> '4' as ok, cast({part('UG1', 1)} as double) as a, cast({part('UG1', 2)} as double) as b, cast({part('UG1', 3)} as double) as c from c)
 select obs_id, case when ok and a <= 14 then a end as swell_period_seconds, round(case when ok and b <= 500 then b * 0.1 end, 6) as swell_height_m, case when ok and c between 1 and 360 then c end as swell_direction_deg from x""")
def swell(spark, sf_dir):
    x = d.decode(cells(spark, sf_dir), "UG1")
    return x.select("obs_id", "ug1_.swell_period_seconds", F.round("ug1_.swell_height_m", 6).alias("swell_height_m"), "ug1_.swell_direction_deg")


@query("V19_supplementary_wind", W + f""", x as (select obs_id, string_split(OD1, ',') as p from c)
 select obs_id, p[3] = '999' and p[4] = '0000' as calm_direction, case when p[3] <> '999' and cast(p[3] as integer) between 1 and 360 then cast(p[3] as double) end as supp_wind_direction_deg,
  round(case when cast(p[4] as integer) <= 2000 then cast(p[4] as double) * 0.1 end, 6) as supp_wind_speed_ms from x""")
def supplementary_wind(spark, sf_dir):
    x = d.decode(cells(spark, sf_dir), "OD1")
    return x.select("obs_id", "od1_.calm_direction", "od1_.supp_wind_direction_deg", F.round("od1_.supp_wind_speed_ms", 6).alias("supp_wind_speed_ms"))


@query("V13_sea_surface", W + f""", x as (select obs_id, {part('SA1', 1)} as t, {part('SA1', 2)} as q from c)
 select obs_id, case when length(ltrim(t, '+-')) <> 4 then 'MALFORMED_TOKEN' when q = '4' then 'BAD_QUALITY_CODE' when cast(t as integer) < -50 then 'OUT_OF_RANGE' end as reason,
  round(case when length(ltrim(t, '+-')) = 4 and q <> '4' and cast(t as integer) >= -50 then cast(t as double) * 0.1 end, 6) as sea_surface_temperature_c from x""")
def sea_surface(spark, sf_dir):
    x = d.decode(cells(spark, sf_dir), "SA1")
    return rounded(x.select("obs_id", F.col("sa1_.sea_surface_temperature_c_qc.reason").alias("reason"), "sa1_.sea_surface_temperature_c"), "sea_surface_temperature_c", to=6)
