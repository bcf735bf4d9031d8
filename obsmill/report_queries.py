"""Registered queries on whole records, reports and manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsmill.functions import decode as d
from obsmill.functions import records
from obsmill.operators import climate, fleet, reports
from obsmill.plans.rules import resolve
from obsmill.queries import CIRC, W_LONG, W_MAN, W_OBS, W_TMP, W_USE, manifests, obs, obs_long, query, rounded, usable, with_tmp

#: Records and remarks from events: sound ones and every kind of fault.
RECORDS = """select event_id as obs_id, case when event_id % 31 = 0 then rpad('0005', 3000, 'x') when event_id % 37 = 0 then rpad('0005', 9000, 'x') when event_id % 29 = 0 then '0003short'
  when event_id % 23 = 0 then rpad('0009', 110, 'x') when event_id % 19 = 0 then rpad('x', 120, 'x') when event_id % 41 = 0 then null
  else rpad(lpad(cast(event_id % 60 as {text}), 4, '0'), cast(105 + event_id % 60 as integer), 'x') end as raw_line,
 case when event_id % 5 = 0 then 'free text ' || cast(event_id as {text}) when event_id % 7 = 0 then 'SYN099short' when event_id % 11 = 0 then 'XYZ003abc' when event_id % 13 = 0 then null
  else 'SYN' || lpad(cast(length(cast(event_id as {text})) + 8 as {text}), 3, '0') || 'station ' || cast(event_id as {text}) || case when event_id % 3 = 0 then 'met004abcd' when event_id % 17 = 0 then 'AWY' else '' end end as REM
 from {events}"""
W_REC = f"with recursive rec as ({RECORDS.format(text='varchar', events='events')})"


def raw_records(spark, sf_dir):
    return spark.sql(RECORDS.format(text="string", events="{events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def temperatures(spark, sf_dir):
    df = with_tmp(obs(spark, sf_dir))
    return df.select("obs_id", "STATION", "DATE", "TMP", "AA1", "VIS", "WND", F.col("x.value").alias("temperature_c"), F.col("x.quality").alias("q"), F.col("x.qc.reason").alias("reason"))


@query("V25_record_structure", W_REC + """ select obs_id, case when length(raw_line) > 8192 then 'block_length_exceeds_max' when length(raw_line) > 2844 then 'record_length_exceeds_max' when length(raw_line) < 105 then 'mandatory_section_short'
 when try_cast(raw_line[1:4] as integer) is null and raw_line is not null or length(raw_line) <> 105 + try_cast(raw_line[1:4] as integer) then 'record_length_mismatch' end as error from rec""")
def record_structure(spark, sf_dir):
    return raw_records(spark, sf_dir).select("obs_id", records.structure_error(F.col("raw_line")).alias("error"))


@query("V31_remarks", W_REC + """, b as (select obs_id, REM as r, 1 as pos, cast('' as varchar) as types, cast('' as varchar) as texts from rec
 union all select obs_id, r, pos + 6 + cast(substr(r, pos + 3, 3) as integer), types || ',' || upper(substr(r, pos, 3)), texts || '|' || substr(r, pos + 6, cast(substr(r, pos + 3, 3) as integer)) from b
 where upper(substr(r, pos, 3)) in ('SYN', 'AWY', 'MET', 'SOD', 'SOM', 'HPD') and regexp_full_match(substr(r, pos + 3, 3), '[0-9]{3}') and pos + 5 + try_cast(substr(r, pos + 3, 3) as integer) <= length(r)),
 e as (select obs_id, substr(types, 2) as types, substr(texts, 2) as texts from b where pos > length(r) and pos > 1)
 select rec.obs_id, e.types as remark_types, e.texts as remark_texts from rec left join e on rec.obs_id = e.obs_id""")
def remarks(spark, sf_dir):
    x = raw_records(spark, sf_dir).select("obs_id", records.remark(F.col("REM")).alias("x"))
    return x.select("obs_id", F.array_join("x.types", ",").alias("remark_types"), F.array_join("x.texts", "|").alias("remark_texts"))


@query("V14_sentinel_leaks", W_TMP + " select STATION, count(*) filter (abs(temperature_c - 999.9) < 1e-6) as n_leaks from tmp group by STATION")
def sentinel_leaks(spark, sf_dir):
    return temperatures(spark, sf_dir).groupBy("STATION").agg(F.count_if(F.abs(F.col("temperature_c") - 999.9) < 1e-6).alias("n_leaks"))


@query("G01_years_in_range", W_LONG + " select STATION, count(*) as n_years from (select distinct STATION, year from lng where year between 1993 and 1996) group by STATION")
def years_in_range(spark, sf_dir):
    return obs_long(spark, sf_dir).where("year between 1993 and 1996").select("STATION", "year").distinct().groupBy("STATION").agg(F.count("*").alias("n_years"))


@query("G02_year_span", W_LONG + " select STATION, min(year) as first_year, max(year) as last_year, count(distinct year) as n_years from lng group by STATION")
def year_span(spark, sf_dir):
    return obs_long(spark, sf_dir).groupBy("STATION").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.countDistinct("year").alias("n_years"))


@query("G05_circular_mean", W_LONG + f" select STATION, month, {CIRC} as wind_direction_deg from lng group by all")
def circular(spark, sf_dir):
    return obs_long(spark, sf_dir).groupBy("STATION", "month").agg(F.round(climate.circular_mean(F.col("wind_direction_deg")), 5).alias("wind_direction_deg"))


@query("G06_weighted_circular_mean", W_LONG + """ select STATION, round(fmod(degrees(atan2(sum((hour + 1) * sin(radians(wind_direction_deg))), sum((hour + 1) * cos(radians(wind_direction_deg))))) + 360, 360), 5) as wind_direction_deg from lng group by STATION""")
def weighted_circular(spark, sf_dir):
    return obs_long(spark, sf_dir).groupBy("STATION").agg(F.round(climate.circular_mean(F.col("wind_direction_deg"), F.col("hour") + 1.0), 5).alias("wind_direction_deg"))


@query("G13_weighted_hours_strategy", W_LONG + """, h as (select STATION, day, count(distinct hour) as hours from lng group by all having count(distinct hour) >= 2), x as (select lng.*, hours from lng join h using (STATION, day)),
 fm as (select STATION, year, month from x group by all having count(distinct day) >= 7), f1 as (select x.* from x semi join fm using (STATION, year, month)), fy as (select STATION, year from f1 group by all having count(distinct month) >= 12)
 select f1.STATION, f1.year, round(sum(temperature_c * hours) / sum(hours), 9) as temperature_c from f1 semi join fy using (STATION, year) group by all""")
def weighted_hours_strategy(spark, sf_dir):
    return rounded(climate.climatology(obs_long(spark, sf_dir), "weighted_hours", {"temperature_c": "mean"}, least_hours=2, least_days=7)["yearly"], "temperature_c")


@query("G16_merged_profiles", W_TMP + " select STATION, count(*) as n_rows, count(*) filter (pass) as n_usable, round(count(*) filter (pass) / count(*), 6) as usable_rate from tmp group by STATION")
def merged_profiles(spark, sf_dir):
    partial = temperatures(spark, sf_dir).groupBy("STATION", F.to_date("DATE").alias("day")).agg(F.count("*").alias("n_rows"), F.count("temperature_c").alias("n_usable"))
    return rounded(reports.merge_profiles(partial, ["STATION"], ["n_rows", "n_usable"], {"usable_rate": ("n_usable", "n_rows")}), "usable_rate", to=6)


@query("G17_fleet_summary", W_TMP + ", s as (select STATION, count(*) as n, count(*) filter (pass) as k from tmp group by STATION) select count(*) as n_stations, cast(sum(n) as bigint) as n_rows, cast(sum(k) as bigint) as n_usable, round(avg(k / n), 9) as mean_rate from s")
def fleet_summary(spark, sf_dir):
    s = temperatures(spark, sf_dir).groupBy("STATION").agg(F.count("*").alias("n"), F.count("temperature_c").alias("k"))
    return s.agg(F.count("*").alias("n_stations"), F.sum("n").alias("n_rows"), F.sum("k").alias("n_usable"), F.round(F.avg(F.col("k") / F.col("n")), 9).alias("mean_rate"))


@query("G25_coverage", W_TMP + """, c as (select STATION, count(distinct date_trunc('hour', DATE)) as raw_hours, count(distinct date_trunc('hour', DATE)) filter (pass) as clean_hours, count(distinct date_trunc('day', DATE)) as raw_days,
 count(distinct date_trunc('day', DATE)) filter (pass) as clean_days, count(distinct date_trunc('month', DATE)) as raw_months, count(distinct date_trunc('month', DATE)) filter (pass) as clean_months from tmp group by STATION)
 select *, round(clean_hours / raw_hours, 6) as retained from c""")
def date_coverage(spark, sf_dir):
    return rounded(reports.coverage(temperatures(spark, sf_dir), "DATE", ["STATION"], F.col("temperature_c").isNotNull()), "retained", to=6)


@query("G26_missingness", W_TMP + """ select 'temperature_c' as field, count(*) as n_rows, count(*) filter (temperature_c is null) as n_missing, round(100 * count(*) filter (temperature_c is null) / count(*), 6) as percent from tmp
 union all select 'AA1', count(*), count(*) filter (AA1 is null), round(100 * count(*) filter (AA1 is null) / count(*), 6) from tmp""")
def missing_values(spark, sf_dir):
    return rounded(reports.missingness(temperatures(spark, sf_dir), ["temperature_c", "AA1"]), "percent", to=6)


@query("G27_sentinel_replacements", W_TMP + " select STATION, count(*) filter (sent and temperature_c is null) as n_replaced from tmp group by STATION")
def sentinel_replacements(spark, sf_dir):
    s = d.is_sentinel(d.token(F.col("TMP"), 1), ("9999",))
    return temperatures(spark, sf_dir).groupBy("STATION").agg(F.count_if(s & F.col("temperature_c").isNull()).alias("n_replaced"))


@query("G28_suspect_quality", W_OBS + " select STATION, count(*) filter (string_split(WND, ',')[5] in ('3', '7')) as n_suspect from obs group by STATION")
def suspect_quality(spark, sf_dir):
    return obs(spark, sf_dir).groupBy("STATION").agg(F.count_if(F.coalesce(d.token(F.col("WND"), 5).isin("3", "7"), F.lit(False))).alias("n_suspect"))


@query("G29_retention", W_TMP + " select count(*) as n_raw, count(*) filter (pass) as n_clean, count(*) filter (not pass) as n_dropped from tmp")
def retention(spark, sf_dir):
    return temperatures(spark, sf_dir).agg(F.count("*").alias("n_raw"), F.count("temperature_c").alias("n_clean"), F.count_if(F.col("temperature_c").isNull()).alias("n_dropped"))


@query("G31_days_per_hour", W_LONG + " select STATION, cast(hour as integer) as hour, count(distinct day) as n_days from lng group by all")
def days_per_hour(spark, sf_dir):
    return obs_long(spark, sf_dir).groupBy("STATION", "hour").agg(F.countDistinct("day").alias("n_days"))


@query("G32_arity_mismatches", W_OBS + " select 'VIS' as field, count(VIS) as present, count(*) filter (len(string_split(VIS, ',')) <> 4) as mismatched from obs union all select 'WND', count(WND), count(*) filter (len(string_split(WND, ',')) <> 5) from obs")
def arity_mismatches(spark, sf_dir):
    return reports.arity(obs(spark, sf_dir), {"VIS": len(resolve("VIS")), "WND": len(resolve("WND"))})


@query("G35_null_rates", W_TMP + """ select STATION, 'raw' as stage, round(count(*) filter (TMP is null) / count(*), 6) as null_rate from tmp group by STATION
 union all select STATION, 'cleaned', round(count(*) filter (temperature_c is null) / count(*), 6) from tmp group by STATION""")
def null_rates(spark, sf_dir):
    rates = temperatures(spark, sf_dir).groupBy("STATION").agg(*[F.round(F.count_if(F.col(c).isNull()) / F.count("*"), 6).alias(n) for n, c in {"raw": "TMP", "cleaned": "temperature_c"}.items()])
    return rates.unpivot("STATION", ["raw", "cleaned"], "stage", "null_rate")


@query("G37_rule_impact", W_TMP + ", c as (select reason, count(*) as n from tmp group by reason) select reason, n, round(n / (select sum(n) from c), 6) as row_share, round(n / (select sum(n) from c where reason is not null), 6) as impact_share from c where reason is not null")
def rule_impact(spark, sf_dir):
    return rounded(reports.impact(temperatures(spark, sf_dir), "reason"), "row_share", "impact_share", to=6)


@query("G40_sizes", """select round(avg(n_chars), 6) as mean, median(n_chars) as median, (select n_chars from documents group by n_chars order by count(*) desc, n_chars limit 1) as mode, min(n_chars) as low, max(n_chars) as high,
 quantile_cont(n_chars, 0.25) as p25, quantile_cont(n_chars, 0.75) as p75, cast(sum(n_chars) as bigint) as total from documents""")
def file_sizes(spark, sf_dir):
    return rounded(reports.sizes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("n_chars"), "n_chars"), "mean", to=6)


@query("G41_ratio_bounds", W_USE + " select STATION, bool_and(n / 6.0 between 0 and 1) as within from u group by STATION")
def ratio_bounds(spark, sf_dir):
    return usable(spark, sf_dir).groupBy("STATION").agg(F.bool_and(F.col("usable_fraction").between(0, 1)).alias("within"))


@query("G42_duplicate_ids", "select o_custkey % 500 as artifact_id, count(*) as n from orders group by all having count(*) > 1")
def duplicate_ids(spark, sf_dir):
    return reports.duplicates(spark.read.parquet(f"{sf_dir}/orders.parquet").select((F.col("o_custkey") % 500).alias("artifact_id")), "artifact_id")


@query("G43_manifest", "select s_nationkey, count(*) as n_rows, cast(cast(sum(cast('0x' || substr(md5(cast(s_suppkey as varchar) || '|' || s_name), 1, 8) as bigint)) as hugeint) as varchar) as checksum from supplier group by s_nationkey")
def manifest_rows(spark, sf_dir):
    return reports.manifest(spark.read.parquet(f"{sf_dir}/supplier.parquet"), "s_nationkey", ["s_suppkey", "s_name"])


@query("G45_integrity_score", W_MAN + " select round((cast(not exists (select 1 from a anti join b using (path)) as integer) + cast(not exists (select 1 from b anti join a using (path)) as integer) + cast(not exists (select path from a group by path having count(*) > 1) as integer)) / 3.0, 6) as score")
def integrity_score(spark, sf_dir):
    a, b = manifests(spark, sf_dir)
    failed = [a.select("path").join(b, "path", "left_anti"), b.select("path").join(a, "path", "left_anti"), reports.duplicates(a, "path")]
    checks = [x.agg((F.count("*") == 0).cast("double").alias("passed")) for x in failed]
    return checks[0].unionAll(checks[1]).unionAll(checks[2]).agg(F.round(F.avg("passed"), 6).alias("score"))


@query("J03_valid_months", W_LONG + ", v as (select STATION, year, month from lng group by all having avg(temperature_c) > 14) select lng.STATION, lng.year, count(*) as n from lng semi join v using (STATION, year, month) group by all")
def valid_months(spark, sf_dir):
    df = obs_long(spark, sf_dir)
    keys = climate.rollup(df, ["STATION", "year", "month"], {"temperature_c": "mean"}).where("temperature_c > 14")
    return df.join(keys, ["STATION", "year", "month"], "left_semi").groupBy("STATION", "year").agg(F.count("*").alias("n"))


@query("J09_station_metadata", W_LONG + ", m as (select STATION, min(year) as first_year, max(year) as last_year, count(*) as n from lng group by STATION) select distinct obs.STATION, first_year, last_year, n from (" + W_OBS.split("as (", 1)[1] + " obs left join m on obs.STATION = m.STATION")
def station_metadata(spark, sf_dir):
    spans = obs_long(spark, sf_dir).groupBy("STATION").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count("*").alias("n"))
    return obs(spark, sf_dir).select("STATION").distinct().join(spans, "STATION", "left")


@query("J11_uncovered", W_MAN + " select a.path from a anti join b using (path)")
def uncovered(spark, sf_dir):
    a, b = manifests(spark, sf_dir)
    return a.select("path").join(b, "path", "left_anti")


@query("J15_sentinel_alignment", W_TMP + " select STATION, count(*) filter (sent) as n_raw, count(*) filter (sent and temperature_c is null) as n_aligned from tmp group by STATION")
def sentinel_alignment(spark, sf_dir):
    s = d.is_sentinel(d.token(F.col("TMP"), 1), ("9999",))
    return temperatures(spark, sf_dir).groupBy("STATION").agg(F.count_if(s).alias("n_raw"), F.count_if(s & F.col("temperature_c").isNull()).alias("n_aligned"))


@query("W06_fingerprints", W_OBS + " select STATION, md5(TMP || '|' || WND) as fingerprint, min(obs_id) as obs_id from obs group by all")
def fingerprints(spark, sf_dir):
    df = obs(spark, sf_dir).select("STATION", "obs_id", F.md5(F.concat_ws("|", "TMP", "WND")).alias("fingerprint"))
    return df.groupBy("STATION", "fingerprint").agg(F.min("obs_id").alias("obs_id"))


@query("W07_first_known", W_OBS + " select STATION, arg_min(AA1, obs_id) filter (AA1 is not null) as AA1 from obs group by STATION")
def first_known(spark, sf_dir):
    return obs(spark, sf_dir).where(F.col("AA1").isNotNull()).groupBy("STATION").agg(F.min_by("AA1", "obs_id").alias("AA1"))


@query("O03_largest", "select doc_id, n_chars from documents order by n_chars desc, doc_id limit 5")
def largest(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(5)


@query("O05_first_rows", W_OBS + " select STATION, obs_id from obs qualify row_number() over (partition by STATION order by obs_id) <= 10")
def first_rows(spark, sf_dir):
    return fleet.first_n(obs(spark, sf_dir).select("STATION", "obs_id"), ["STATION"], ["obs_id"], 10)


@query("U01_union_by_name", W_MAN + " select path, checksum, null as k from b where false union all select path, checksum, 1 from a union all select path, null, 2 from b")
def union_by_name(spark, sf_dir):
    a, b = manifests(spark, sf_dir)
    return a.select("path", "checksum", F.lit(1).alias("k")).unionByName(b.select(F.lit(2).alias("k"), "path"), allowMissingColumns=True)


@query("U04_group_keys", W_LONG + " select distinct STATION, year from lng")
def group_keys(spark, sf_dir):
    return obs_long(spark, sf_dir).select("STATION", "year").distinct()


#: Original-observation texts from events, sound and broken.
QNN = """select event_id as obs_id, case when event_id % 11 = 0 then null when event_id % 7 = 0 then 'QNNZ1234000123' when event_id % 5 = 0 then 'QNNA123400012' when event_id % 13 = 0 then 'QNNA12 3400 0123'
  else 'qnn' || substr('A1234B0000C9Z9X', 1, cast(5 + 5 * (event_id % 3) as integer)) || case when event_id % 2 = 0 then ' ' else '' end || substr('000123-00456000789', 1, cast(6 + 6 * (event_id % 3) as integer)) end as QNN from {events}"""


@query("V32_original_observations", f"with q as ({QNN.format(text='varchar', events='events')})" + r""", b as (select obs_id, QNN, regexp_replace(QNN[4:], '\s', '', 'g') as bare, length(regexp_replace(QNN[4:], '\s', '', 'g')) // 11 as n from q),
 k as (select *, upper(QNN[1:3]) = 'QNN' and length(bare) = 11 * n and regexp_full_match(QNN[4:], '(\s*[A-Y]\s*[^\s,]{4}){' || n || '}(\s*[^\s,]{6}){' || n || '}\s*') as good from b)
 select obs_id, case when good then array_to_string([bare[5 * i + 1 : 5 * i + 1] for i in range(n)], ',') end as elements, case when good then array_to_string([bare[5 * i + 2 : 5 * i + 5] for i in range(n)], ',') end as flags,
 case when good then array_to_string([bare[5 * n + 6 * i + 1 : 5 * n + 6 * i + 6] for i in range(n)], ',') end as data_values from k""")
def original_observations(spark, sf_dir):
    df = spark.sql(QNN.format(text="string", events="{events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))
    x = df.select("obs_id", records.original_observation(F.col("QNN")).alias("x"))
    return x.select("obs_id", *[F.array_join(f"x.{c}", ",").alias(c) for c in ("elements", "flags", "data_values")])


@query("V36_contract_columns", W_OBS + " select obs_id, STATION as station_id, cast(year(DATE) as integer) as YEAR from obs")
def contract_columns(spark, sf_dir):
    return obs(spark, sf_dir).select("obs_id", F.col("STATION").alias("station_id"), F.year("DATE").alias("YEAR"))


@query("J06_upsert", """with o as (select o_custkey as k, max(o_orderkey) as at from orders where o_orderkey % 2 = 0 group by o_custkey), n as (select o_custkey as k, max(o_orderkey) as at from orders where o_orderkey % 5 = 1 group by o_custkey)
 select coalesce(n.k, o.k) as station_id, coalesce(n.at, o.at) as pulled_at, n.k is not null as renewed from o full join n on o.k = n.k""")
def upserted(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("station_id"), F.col("o_orderkey").alias("pulled_at"))
    old, new = o.where("pulled_at % 2 = 0").withColumn("renewed", F.lit(False)), o.where("pulled_at % 5 = 1").withColumn("renewed", F.lit(True))
    return fleet.upsert(old, new, "station_id", "pulled_at")


@query("J08_unused_stations", "select c_custkey as station_id from customer where c_custkey not in (select o_custkey from orders)")
def unused_stations(spark, sf_dir):
    used = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("station_id"))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("station_id")).join(used, "station_id", "left_anti")


#: A manifest from parts: each row refers to two other rows, some of which are missing.
LINEAGE = """select cast(p_partkey as {text}) as artifact_id, '["' || cast(p_partkey + 1 as {text}) || '","' || cast(p_partkey * 2 as {text}) || '"]' as upstream from {part} where p_partkey % 17 <> 0"""


@query("J13_lineage", f"with m as ({LINEAGE.format(text='varchar', part='part')}), r as (select artifact_id, unnest(string_split(regexp_replace(upstream, '[^0-9,]', '', 'g'), ',')) as reference from m) select artifact_id, reference from r where reference not in (select artifact_id from m)")
def lineage(spark, sf_dir):
    m = spark.sql(LINEAGE.format(text="string", part="{part}"), part=spark.read.parquet(f"{sf_dir}/part.parquet"))
    return fleet.unresolved(m, "artifact_id", "upstream")


@query("G21_domain_usability", W_TMP + """, x as (select STATION, 'temperature' as domain, temperature_c is not null as ok from tmp union all select STATION, 'wind', string_split(WND, ',')[1] <> '999' or string_split(WND, ',')[4] <> '9999' from tmp
 union all select STATION, 'visibility', len(string_split(VIS, ',')) = 4 and string_split(VIS, ',')[1] <> '999999' from tmp) select STATION, domain, count(*) as n_rows, count(*) filter (ok) as n_usable, round(count(*) filter (ok) / count(*), 6) as usable_rate from x group by all""")
def domain_rates(spark, sf_dir):
    df = obs(spark, sf_dir)
    for name in ("TMP", "WND", "VIS"):
        df = d.decode(df, name)
    df = df.select("STATION", "tmp_.temperature_c", "wnd_.wind_direction_deg", "wnd_.wind_speed_ms", "vis_.visibility_m")
    domains = {"temperature": ["temperature_c"], "wind": ["wind_direction_deg", "wind_speed_ms"], "visibility": ["visibility_m"]}
    return rounded(reports.domain_usability(df, domains, ["STATION"]), "usable_rate", to=6)


@query("O01_publishing_order", W_OBS + " select STATION, DATE, obs_id from obs order by STATION, DATE, obs_id")
def publishing_order(spark, sf_dir):
    return obs(spark, sf_dir).select("STATION", "DATE", "obs_id").orderBy("STATION", "DATE", "obs_id")
