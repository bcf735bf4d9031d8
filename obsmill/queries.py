"""Registered queries over tables derived from the given ones, each with its equivalent in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsmill.functions import decode as d
from obsmill.functions.units import add_units
from obsmill.operators import climate, fleet, gaps, quality
from obsmill.plans.rules import MANDATORY_QUALITY, resolve

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Coded observations from events: every kind of defect occurs, by arithmetic on the id.
OBS = """select event_id as obs_id, lpad(cast(user_id % 20 as {text}), 11, '0') as STATION, ts as DATE,
 case when event_id % 17 = 0 then '+9999,9' when event_id % 19 = 0 then '+12A4,1' when event_id % 23 = 0 then '+0180,8'
      when event_id % 29 = 0 then '+180,1' when event_id % 31 = 0 then '+0700,1'
      else (case when event_id % 5 = 0 then '-' else '+' end) || lpad(cast((event_id * 7) % 400 as {text}), 4, '0') || ',1' end as TMP,
 case when event_id % 11 = 0 then '999,9,9,0000,1' when event_id % 13 = 0 then '999,9,V,0031,1' when event_id % 17 = 0 then '999,9,9,9999,9'
      else lpad(cast(1 + (event_id * 37) % 360 as {text}), 3, '0') || ',1,N,' || lpad(cast((event_id * 3) % 300 as {text}), 4, '0') || ',' || (case when event_id % 41 = 0 then '3' else '1' end) end as WND,
 case when event_id % 7 = 0 then '999999,9,N,1' when event_id % 43 = 0 then '010000,1,N'
      else lpad(cast((event_id * 113) % 170000 as {text}), 6, '0') || ',1,N,1' end as VIS,
 case when event_id % 3 = 0 then null when event_id % 10 = 0 then '99,9999,9,9'
      else lpad(cast(1 + event_id % 24 as {text}), 2, '0') || ',' || lpad(cast((event_id * 11) % 500 as {text}), 4, '0') || ',9,1' end as AA1
from {events}"""
#: Observations over several years from orders.
LONG = """select o_orderkey as obs_id, lpad(cast(o_custkey % 2 as {text}), 11, '0') as STATION, cast(o_orderdate as timestamp) as ORDERED, (o_orderkey % 4) * 6 as HOURS,
 cast(o_totalprice as double) / 10000.0 as temperature_c, (o_orderkey * 37) % 360 as wind_direction_deg from {orders}"""


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(OBS.format(text="string", events="{events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def with_tmp(df: DataFrame) -> DataFrame:
    """df with x: value, quality and qc of TMP, and t, its value."""
    x = F.struct(F.col("tmp_.temperature_c").alias("value"), F.col("tmp_.quality").alias("quality"), F.col("tmp_.temperature_c_qc").alias("qc"))
    return d.decode(df, "TMP").withColumns({"x": x, "t": F.col("tmp_.temperature_c")})


def obs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.sql(LONG.format(text="string", orders="{orders}"), orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))
    df = df.withColumn("DATE", F.timestamp_add("HOUR", F.col("HOURS").cast("int"), F.col("ORDERED")))
    return climate.times(df.drop("ORDERED", "HOURS"))


T1, Q1 = "trim(string_split(TMP, ',')[1])", "trim(string_split(TMP, ',')[2])"
NUM = r"case when regexp_full_match(regexp_replace({0}, '^\+', ''), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)') then cast(regexp_replace({0}, '^\+', '') as double) end"
PLAIN = r"regexp_replace(regexp_replace({0}, '[.+]', '', 'g'), '^(-?)0+(.)', '\1\2')"
W_OBS = f"with obs as ({OBS.format(text='varchar', events='events')})"
W_TMP = W_OBS + f""", t0 as (select *, {T1} as tok, {Q1} as q, {NUM.format(T1)} as num, {PLAIN.format(T1)} = '9999' as sent,
 length(regexp_replace({T1}, '^[+-]+', '')) <> 4 as wid from obs),
t1 as (select *, wid or (not sent and num is null) as mal, q not in ('0','1','2','3','4','5','6','7','9','A','C','I','M','P','R','U') and not wid as bad from t0),
t2 as (select *, case when mal then 'MALFORMED_TOKEN' when bad then 'BAD_QUALITY_CODE' when sent then 'SENTINEL_MISSING' when num < -932 or num > 618 then 'OUT_OF_RANGE' end as reason from t1),
tmp as (select *, case when reason is null then num * 0.1 end as temperature_c, coalesce(reason is null, false) as pass,
 case when reason is null then 'PASS' when reason = 'SENTINEL_MISSING' then 'MISSING' else 'INVALID' end as status from t2)"""
W_LONG = f"""with l0 as ({LONG.format(text='varchar', orders='orders')}), l1 as (select obs_id, STATION, temperature_c, wind_direction_deg, ORDERED + to_hours(cast(HOURS as integer)) as DATE from l0),
lng as (select *, year(DATE) as year, month(DATE) as month, cast(DATE as date) as day, hour(DATE) as hour from l1)"""
W_FULL = W_LONG + """, fm as (select STATION, year, month from lng group by all having count(distinct day) >= 20), f1 as (select lng.* from lng semi join fm using (STATION, year, month)),
fy as (select STATION, year from f1 group by all having count(distinct month) >= 12), full_ as (select f1.* from f1 semi join fy using (STATION, year))"""
CIRC = "case when count(wind_direction_deg) > 0 then round(fmod(degrees(atan2(sum(sin(radians(wind_direction_deg))), sum(cos(radians(wind_direction_deg))))) + 360, 360), 5) end"
HOW = {"temperature_c": "mean", "wind_direction_deg": "circular_mean"}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def rounded(df: DataFrame, *columns: str, to: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, to) for c in columns})


@query("V01_tokenise", W_OBS + " select obs_id, len(string_split(WND, ',')) as n_tokens, trim(string_split(WND, ',')[4]) as token4, string_split(VIS, ',')[4] as vis4 from obs")
def tokenise(spark, sf_dir):
    return obs(spark, sf_dir).select("obs_id", F.size(d.raw_tokens(F.col("WND"))).cast("long").alias("n_tokens"), d.token(F.col("WND"), 4).alias("token4"), d.token(F.col("VIS"), 4).alias("vis4"))


@query("V02_number", W_OBS + f" select obs_id, {NUM.format(T1)} as num from obs")
def numbers(spark, sf_dir):
    return obs(spark, sf_dir).select("obs_id", d.number(d.token(F.col("TMP"), 1)).alias("num"))


@query("V03_sentinel", W_OBS + f" select obs_id, {PLAIN.format(T1)} = '9999' as tmp_missing, regexp_full_match(regexp_replace(string_split(WND, ',')[1], '[.+]', '', 'g'), '9{{2,}}') as wnd_nines from obs")
def sentinels(spark, sf_dir):
    return obs(spark, sf_dir).select("obs_id", d.is_sentinel(d.token(F.col("TMP"), 1), ("9999",)).alias("tmp_missing"), d.is_sentinel(d.token(F.col("WND"), 1), None).alias("wnd_nines"))


@query("V04_domain", W_OBS + " select obs_id, case when string_split(WND, ',')[3] in ('A','B','C','H','N','R','Q','T','V') then string_split(WND, ',')[3] end as wind_type_code, string_split(WND, ',')[3] not in ('A','B','C','H','N','R','Q','T','V') as domain_invalid, false as pattern_mismatch from obs")
def domains(spark, sf_dir):
    return obs(spark, sf_dir).select("obs_id", d.check_domain(d.token(F.col("WND"), 3), resolve("WND")[2]).alias("x")).select("obs_id", F.col("x.value").alias("wind_type_code"), "x.domain_invalid", "x.pattern_mismatch")


@query("V06_quality_code", W_OBS + f" select obs_id, {Q1} as quality, {Q1} in ('0','1','2','3','4','5','6','7','9') as allowed from obs")
def quality_codes(spark, sf_dir):
    q = d.token(F.col("TMP"), 2)
    return obs(spark, sf_dir).select("obs_id", q.alias("quality"), q.isin(*MANDATORY_QUALITY).alias("allowed"))


@query("V13_two_part", W_TMP + " select obs_id, round(temperature_c, 6) as temperature_c, q as quality, pass, status, reason from tmp")
def two_part(spark, sf_dir):
    return with_tmp(obs(spark, sf_dir)).select("obs_id", F.round("x.value", 6).alias("temperature_c"), "x.quality", F.col("x.qc")["pass"].alias("pass"), "x.qc.status", "x.qc.reason")


W_WND = W_OBS + """, w0 as (select *, string_split(WND, ',') as p from obs), w1 as (select obs_id, STATION, DATE, p[1] = '999' as dsent, p[3] = 'V' and p[1] = '999' as variable, p[3] = '9' and p[4] = '0000' as calm,
 cast(p[1] as double) as dir, cast(p[4] as double) as spd, p[4] = '9999' as ssent, p[5] as q5 from w0)"""


@query("V15_multi_part", W_WND + """ select obs_id, case when not dsent then dir end as wind_direction_deg, case when dsent then 'SENTINEL_MISSING' end as direction_reason,
 round(case when not ssent then spd * 0.1 end, 6) as wind_speed_ms, case when ssent then 'SENTINEL_MISSING' end as speed_reason, q5 from w1""")
def multi_part(spark, sf_dir):
    x = d.decode(obs(spark, sf_dir), "WND")
    return x.select("obs_id", "wnd_.wind_direction_deg", F.col("wnd_.wind_direction_deg_qc.reason").alias("direction_reason"), F.round("wnd_.wind_speed_ms", 6).alias("wind_speed_ms"), F.col("wnd_.wind_speed_ms_qc.reason").alias("speed_reason"), "wnd_.q5")


@query("V16_arity", W_OBS + """ select obs_id, case when len(string_split(VIS, ',')) = 4 and string_split(VIS, ',')[1] <> '999999' then least(cast(string_split(VIS, ',')[1] as double), 160000) end as visibility_m,
 len(string_split(VIS, ',')) <> 4 as mismatch from obs""")
def arity(spark, sf_dir):
    return d.decode(obs(spark, sf_dir), "VIS").select("obs_id", "vis_.visibility_m", (F.size(d.raw_tokens(F.col("VIS"))) != 4).alias("mismatch"))


@query("V19_wind_cases", W_WND + " select STATION, count(*) filter (calm) as n_calm, count(*) filter (variable) as n_variable from w1 group by STATION")
def wind_cases(spark, sf_dir):
    return d.decode(obs(spark, sf_dir), "WND").groupBy("STATION").agg(F.count_if("wnd_.calm").alias("n_calm"), F.count_if("wnd_.direction_variable").alias("n_variable"))


W_USE = W_TMP + """, u as (select tmp.obs_id, tmp.STATION, tmp.DATE, cast(tmp.pass as integer) + cast(coalesce(string_split(WND, ',')[1] <> '999', false) as integer) + cast(coalesce(string_split(WND, ',')[4] <> '9999', false) as integer)
 + cast(coalesce(len(string_split(VIS, ',')) = 4 and string_split(VIS, ',')[1] <> '999999', false) as integer) + cast(coalesce(string_split(AA1, ',')[1] <> '99', false) as integer) + cast(coalesce(string_split(AA1, ',')[2] <> '9999', false) as integer) as n from tmp)"""


def usable(spark, sf_dir) -> DataFrame:
    df = d.decode_all(obs(spark, sf_dir), ["TMP", "WND", "VIS", "AA1"])
    passes = [F.col(c)["pass"] for c in ("tmp_.temperature_c_qc", "wnd_.wind_direction_deg_qc", "wnd_.wind_speed_ms_qc", "vis_.visibility_m_qc", "aa1_.precip_period_hours_qc", "aa1_.precip_amount_qc")]
    return df.select("*", *d.usability(passes))


@query("V33_usability", W_USE + " select obs_id, n > 0 as any_usable, n as n_usable, round(n / 6.0, 6) as usable_fraction from u")
def row_usability(spark, sf_dir):
    return rounded(usable(spark, sf_dir).select("obs_id", "any_usable", "n_usable", "usable_fraction"), "usable_fraction", to=6)


@query("G22_station_years", W_USE + " select STATION, year(DATE) as year, count(*) as n_rows, count(*) filter (n >= 4) as n_usable, count(*) filter (n < 4) as n_lost, round(count(*) filter (n >= 4) / count(*), 6) as usable_rate from u group by all")
def station_years(spark, sf_dir):
    df = usable(spark, sf_dir).withColumns({"year": F.year("DATE"), "ok": F.col("n_usable") >= 4})
    return rounded(quality.station_years(df.drop("n_usable"), "ok"), "usable_rate", to=6)


@query("V40_suspect_to_null", W_WND + " select obs_id, round(case when q5 not in ('3', '7') and not ssent then spd * 0.1 end, 6) as wind_speed_ms from w1")
def suspects(spark, sf_dir):
    x = d.decode(obs(spark, sf_dir), "WND")
    return x.select("obs_id", F.round(F.when(~F.col("wnd_.q5").isin("3", "7"), F.col("wnd_.wind_speed_ms")), 6).alias("wind_speed_ms"))


@query("V41_units", W_TMP + " select obs_id, round(temperature_c * 9 / 5 + 32, 9) as temperature_f from tmp")
def units(spark, sf_dir):
    df = with_tmp(obs(spark, sf_dir)).select("obs_id", F.col("t").alias("temperature_c"))
    return rounded(add_units(df).select("obs_id", F.col("temperature_c_f").alias("temperature_f")), "temperature_f")


@query("V38_times", W_LONG + " select obs_id, cast(year as integer) as year, cast(month as integer) as month, day, cast(hour as integer) as hour from lng")
def time_columns(spark, sf_dir):
    return obs_long(spark, sf_dir).select("obs_id", "year", "month", "day", "hour")


@query("J01_full_months", W_LONG + ", fm as (select STATION, year, month from lng group by all having count(distinct day) >= 20) select lng.STATION, count(*) as n from lng semi join fm using (STATION, year, month) group by lng.STATION")
def months(spark, sf_dir):
    return climate.full_months(obs_long(spark, sf_dir)).groupBy("STATION").agg(F.count("*").alias("n"))


@query("J02_full_years", W_FULL + " select STATION, year, count(*) as n from full_ group by all")
def years(spark, sf_dir):
    return climate.full_years(climate.full_months(obs_long(spark, sf_dir))).groupBy("STATION", "year").agg(F.count("*").alias("n"))


@query("J04_hour_weights", W_LONG + " select STATION, day, count(distinct hour) as hours from lng group by all having count(distinct hour) >= 2")
def weights(spark, sf_dir):
    return climate.hour_weights(obs_long(spark, sf_dir), 2).select("STATION", "day", "hours").distinct()


@query("G03_best_hour", W_LONG + ", h as (select STATION, hour, count(distinct day) as n from lng group by all) select STATION, cast(arg_max(hour, n * 100 - hour) as integer) as hour from h group by STATION")
def best_hour(spark, sf_dir):
    return climate.best_hours(obs_long(spark, sf_dir))


@query("G04_rollup", W_LONG + f" select STATION, year, round(avg(temperature_c), 9) as temperature_c, {CIRC} as wind_direction_deg from lng group by all")
def rollups(spark, sf_dir):
    return rounded(rounded(climate.rollup(obs_long(spark, sf_dir), ["STATION", "year"], HOW), "temperature_c"), "wind_direction_deg", to=5)


@query("G07_mode", W_LONG + ", c as (select STATION, wind_direction_deg as v, count(*) as n from lng group by all), m as (select STATION, max(n) as n from c group by STATION) select STATION, min(v) as wind_direction_deg from c join m using (STATION, n) group by STATION")
def modes(spark, sf_dir):
    return climate.rollup(obs_long(spark, sf_dir), ["STATION"], {"wind_direction_deg": "mode"})


@query("G08_weighted", W_LONG + ", h as (select STATION, day, count(distinct hour) as hours from lng group by all), x as (select lng.*, hours from lng join h using (STATION, day)) select STATION, year, round(sum(temperature_c * hours) / sum(hours), 9) as temperature_c from x group by all")
def weighted(spark, sf_dir):
    df = climate.hour_weights(obs_long(spark, sf_dir), 1)
    return rounded(climate.weighted_rollup(df, ["STATION", "year"], {"temperature_c": "mean"}, "hours"), "temperature_c")


@query("G09_daily_triples", W_LONG + " select STATION, day, round(min(temperature_c), 9) as temperature_c__daily_min, round(max(temperature_c), 9) as temperature_c__daily_max, round(avg(temperature_c), 9) as temperature_c__daily_mean from lng group by all")
def triples(spark, sf_dir):
    out = climate.daily_triples(obs_long(spark, sf_dir), ["STATION", "day"], {"temperature_c": "mean"})
    return rounded(out, *[c for c in out.columns if "__" in c])


@query("G10_best_hour_strategy", W_LONG + """, h as (select STATION, hour, count(distinct day) as n from lng group by all), b as (select STATION, arg_max(hour, n * 100 - hour) as hour from h group by STATION), r as (select lng.* from lng semi join b using (STATION, hour)),
 fm as (select STATION, year, month from r group by all having count(distinct day) >= 7), f1 as (select r.* from r semi join fm using (STATION, year, month)), fy as (select STATION, year from f1 group by all having count(distinct month) >= 12)
 select f1.STATION, f1.year, round(avg(temperature_c), 9) as temperature_c from f1 semi join fy using (STATION, year) group by all""")
def best_hour_strategy(spark, sf_dir):
    return rounded(climate.climatology(obs_long(spark, sf_dir), "best_hour", {"temperature_c": "mean"}, least_days=7)["yearly"], "temperature_c")


@query("G11_fixed_hour_strategy", W_LONG + """, r as (select * from lng where hour = 6), fm as (select STATION, year, month from r group by all having count(distinct day) >= 7), f1 as (select r.* from r semi join fm using (STATION, year, month)), fy as (select STATION, year from f1 group by all having count(distinct month) >= 12)
 select f1.STATION, f1.year, f1.month, round(avg(temperature_c), 9) as temperature_c from f1 semi join fy using (STATION, year) group by all""")
def fixed_hour_strategy(spark, sf_dir):
    return rounded(climate.climatology(obs_long(spark, sf_dir), "fixed_hour", {"temperature_c": "mean"}, hour=6, least_days=7)["monthly"], "temperature_c")


@query("G12_nested_strategy", W_FULL + """, h as (select STATION, year, month, day, hour, avg(temperature_c) as t from full_ group by all), dd as (select STATION, year, month, day, avg(t) as t from h group by all)
 select STATION, year, month, round(avg(t), 9) as temperature_c from dd group by all""")
def nested_strategy(spark, sf_dir):
    return rounded(climate.climatology(obs_long(spark, sf_dir), "hour_day_month_year", {"temperature_c": "mean"})["monthly"], "temperature_c")


@query("G14_daily_strategy", W_FULL + """, dd as (select STATION, year, month, day, min(temperature_c) as a, max(temperature_c) as b, avg(temperature_c) as c from full_ group by all)
 select STATION, year, round(avg(a), 9) as temperature_c__daily_min, round(avg(b), 9) as temperature_c__daily_max, round(avg(c), 9) as temperature_c__daily_mean from dd group by all""")
def daily_strategy(spark, sf_dir):
    out = climate.climatology(obs_long(spark, sf_dir), "daily_min_max_mean", {"temperature_c": "mean"})["yearly"]
    return rounded(out, *[c for c in out.columns if "__" in c])


@query("G18_completeness", W_TMP + """ select STATION, 'temperature_c' as field, count(*) as n_rows, count(*) filter (temperature_c is null) as n_null, round(1 - count(*) filter (temperature_c is null) / count(*), 6) as completeness from tmp group by STATION
 union all select STATION, 'AA1', count(*), count(*) filter (AA1 is null), round(1 - count(*) filter (AA1 is null) / count(*), 6) from tmp group by STATION""")
def completeness(spark, sf_dir):
    df = with_tmp(obs(spark, sf_dir)).withColumn("temperature_c", F.col("t").cast("string"))
    return rounded(quality.completeness(df, ["temperature_c", "AA1"]), "completeness", to=6)


@query("G19_sentinels", W_TMP + " select STATION, count(*) filter (sent) as n_sentinel, round(count(*) filter (sent) / count(*), 6) as sentinel_rate from tmp group by STATION")
def sentinel_rates(spark, sf_dir):
    s = d.is_sentinel(d.token(F.col("TMP"), 1), ("9999",))
    return obs(spark, sf_dir).groupBy("STATION").agg(F.count_if(s).alias("n_sentinel"), F.round(F.count_if(s) / F.count("*"), 6).alias("sentinel_rate"))


@query("G20_exclusions", W_TMP + " select STATION, count(*) filter (reason = 'BAD_QUALITY_CODE') as n_excluded from tmp group by STATION")
def exclusions(spark, sf_dir):
    return with_tmp(obs(spark, sf_dir)).groupBy("STATION").agg(F.count_if(F.col("x.qc.reason") == "BAD_QUALITY_CODE").alias("n_excluded"))


@query("G23_distribution", W_TMP + """ select STATION, count(temperature_c) as n, round(min(temperature_c), 6) as low, round(max(temperature_c), 6) as high, round(avg(temperature_c), 9) as mean, round(quantile_cont(temperature_c, 0.05), 9) as p05, round(quantile_cont(temperature_c, 0.25), 9) as p25,
 round(quantile_cont(temperature_c, 0.5), 9) as median, round(quantile_cont(temperature_c, 0.75), 9) as p75, round(quantile_cont(temperature_c, 0.95), 9) as p95 from tmp group by STATION""")
def distribution(spark, sf_dir):
    df = with_tmp(obs(spark, sf_dir))
    return rounded(rounded(quality.distribution(df, "t", ["STATION"]), "mean", "p05", "p25", "median", "p75", "p95"), "low", "high", to=6)


@query("G33_reasons", W_TMP + " select STATION, 'temperature_c' as field, reason, count(*) as n from tmp where reason is not null group by all")
def reasons(spark, sf_dir):
    df = d.decode(obs(spark, sf_dir), "TMP").select("STATION", F.col("tmp_.temperature_c_qc").alias("v"))
    return quality.reasons(df, {"temperature_c": "v"})


@query("W01_missing_runs", W_TMP + """, s as (select STATION, DATE, temperature_c, count(temperature_c) over (partition by STATION order by DATE, obs_id) as run from tmp), r as (select STATION, run, count(*) as length, min(DATE) as b, max(DATE) as e from s where temperature_c is null group by all),
 k as (select *, row_number() over (partition by STATION order by length desc, run) as n from r) select STATION, length, b as begin, e as "end", round(date_diff('second', date_trunc('second', b), date_trunc('second', e)) / 3600.0, 9) as hours from k where n = 1""")
def missing_runs(spark, sf_dir):
    df = with_tmp(obs(spark, sf_dir))
    return rounded(gaps.longest_missing_run(df, "t"), "hours")


@query("W02_inventory", """with r as (select doc_id, source, n_chars, row_number() over (partition by source order by n_chars, doc_id) as rank, count(*) over (partition by source) as n from documents)
 select doc_id, rank, round(case when n > 1 then (rank - 1) / (n - 1) else 1.0 end, 6) as percentile, cast(floor((rank - 1) * 4 / n) as integer) + 1 as quartile from r""")
def inventory(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "n_chars")
    return rounded(fleet.inventory(docs, "n_chars", "doc_id", ["source"]).select("doc_id", "rank", "percentile", "quartile"), "percentile", to=6)


@query("W05_keep_first", "select s_nationkey, s_suppkey from (select *, row_number() over (partition by s_nationkey order by s_suppkey) as n from supplier) where n = 1")
def first_of_key(spark, sf_dir):
    return fleet.keep_first(spark.read.parquet(f"{sf_dir}/supplier.parquet"), ["s_nationkey"], ["s_suppkey"]).select("s_nationkey", "s_suppkey")


def pull_states(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("station_id"))
    old = c.where("station_id % 2 = 0").select("station_id", (F.col("station_id") % 3 == 0).alias("pulled"), F.concat(F.lit("old/"), F.col("station_id").cast("string")).alias("raw_path"))
    new = c.where("station_id % 5 <> 0").select("station_id", (F.col("station_id") % 7 == 0).alias("pulled"), F.concat(F.lit("new/"), F.col("station_id").cast("string")).alias("raw_path"))
    return c, old, new


W_PULL = """with o as (select c_custkey as station_id, c_custkey % 3 = 0 as pulled, 'old/' || c_custkey as raw_path from customer where c_custkey % 2 = 0), n as (select c_custkey as station_id, c_custkey % 7 = 0 as pulled, 'new/' || c_custkey as raw_path from customer where c_custkey % 5 <> 0),
 m as (select coalesce(o.station_id, n.station_id) as station_id, coalesce(o.pulled, false) or coalesce(n.pulled, false) as pulled, coalesce(o.raw_path, n.raw_path) as raw_path from o full join n on o.station_id = n.station_id)"""


@query("J05_pull_state", W_PULL + " select * from m")
def pull_state(spark, sf_dir):
    _, old, new = pull_states(spark, sf_dir)
    return fleet.merge_pull_state(old, new)


@query("J07_pending", W_PULL + " select c_custkey as station_id from customer where c_custkey not in (select station_id from m where pulled)")
def pending(spark, sf_dir):
    c, old, new = pull_states(spark, sf_dir)
    return fleet.pending(c, fleet.merge_pull_state(old, new))


def manifests(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").cast("string").alias("path"), F.md5("p_name").alias("checksum"), F.col("p_partkey").alias("k"))
    return p.where("k % 11 <> 0"), p.where("k % 13 <> 0").withColumn("checksum", F.when(F.col("k") % 97 == 0, F.md5("checksum")).otherwise(F.col("checksum")))


W_MAN = """with a as (select cast(p_partkey as varchar) as path, md5(p_name) as checksum from part where p_partkey % 11 <> 0), b as (select cast(p_partkey as varchar) as path, case when p_partkey % 97 = 0 then md5(md5(p_name)) else md5(p_name) end as checksum from part where p_partkey % 13 <> 0)"""


@query("J10_presence", W_MAN + " select coalesce(a.path, b.path) as path, case when b.path is null then 'missing' when a.path is null then 'unexpected' else 'present' end as state from a full join b on a.path = b.path")
def presence(spark, sf_dir):
    return fleet.presence(*manifests(spark, sf_dir))


@query("J12_checksums", W_MAN + " select a.path, a.checksum as left_checksum, b.checksum as right_checksum from a join b on a.path = b.path where a.checksum <> b.checksum")
def checksums(spark, sf_dir):
    return fleet.checksum_conflicts(*manifests(spark, sf_dir))


@query("U02_path_difference", W_MAN + " select path from a except select path from b")
def difference(spark, sf_dir):
    a, b = manifests(spark, sf_dir)
    return a.select("path").subtract(b.select("path"))


@query("U03_symmetric_difference", W_MAN + " (select path from a except select path from b) union all (select path from b except select path from a)")
def symmetric(spark, sf_dir):
    a, b = (x.select("path") for x in manifests(spark, sf_dir))
    return a.subtract(b).unionAll(b.subtract(a))


@query("G38_run_states", "select case when s_suppkey % 10 = 0 then 'failed' when s_suppkey % 10 < 3 then 'running' else 'done' end as status, count(*) as n from supplier group by all")
def run_states(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select((F.col("s_suppkey") % 10).alias("k"))
    return s.groupBy(F.when(F.col("k") == 0, "failed").when(F.col("k") < 3, "running").otherwise("done").alias("status")).agg(F.count("*").alias("n"))


@query("G39_progress", "select count(*) as n, round(avg(s_suppkey % 60), 9) as mean_seconds, median(s_suppkey % 60) as median_seconds from supplier")
def progress(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select((F.col("s_suppkey") % 60).alias("k"))
    return s.agg(F.count("*").alias("n"), F.round(F.avg("k"), 9).alias("mean_seconds"), F.median("k").alias("median_seconds"))


@query("O02_top_records", W_TMP + " select STATION, n from (select STATION, count(*) filter (not pass) as n from tmp group by STATION) order by n desc, STATION limit 10")
def top_records(spark, sf_dir):
    return with_tmp(obs(spark, sf_dir)).groupBy("STATION").agg(F.count_if(~F.coalesce(F.col("x.qc.pass"), F.lit(False))).alias("n")).orderBy(F.desc("n"), "STATION").limit(10)


@query("W04_diverse_sample", W_OBS + ", r as (select obs_id, STATION, row_number() over (partition by STATION order by obs_id) as n from obs) select obs_id, STATION, n from r order by n, STATION limit 50")
def diverse_sample(spark, sf_dir):
    r = obs(spark, sf_dir).select("obs_id", "STATION", F.row_number().over(Window.partitionBy("STATION").orderBy("obs_id")).alias("n"))
    return r.where("n <= 50").orderBy("n", "STATION").limit(50)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
