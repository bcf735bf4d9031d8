"""Registered queries on ranks and selections, files of stations, schemas, full profiles, assessments and streams, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsmill.functions import decode as d
from obsmill.operators import cleaning, profiles, quality, ranking, reports, schemas
from obsmill.queries import OBS, W_OBS, W_TMP, obs, query, rounded, with_tmp
from obsmill.clean_queries import W_VERDICTS
from obsmill.sources import folders
from obsmill.streaming import incremental

W_RANKED = """with r as (select doc_id, n_chars, row_number() over (order by n_chars, doc_id) as rank, count(*) over () as n from documents where doc_id is not null and n_chars is not null),
 q as (select *, cast((rank - 1) * 4 // n as integer) + 1 as quartile from r), i as (select *, row_number() over (partition by quartile order by rank) as quartile_rank, count(*) over (partition by quartile) as size from q)"""


def sizes(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "n_chars")


@query("W02_global_inventory", W_RANKED + """ select doc_id, rank, round(case when n > 1 then (rank - 1) / (n - 1) else 1.0 end, 9) as percentile, quartile, quartile_rank,
 round(case when size > 1 then (quartile_rank - 1) / (size - 1) else 1.0 end, 9) as quartile_percentile from i""")
def global_inventory(spark, sf_dir):
    out, _ = ranking.size_inventory(sizes(spark, sf_dir), "n_chars", "doc_id")
    return rounded(out.select("doc_id", "rank", "percentile", "quartile", "quartile_rank", "quartile_percentile"), "percentile", "quartile_percentile")


#: 54 rows: quotas 14, 14, 13, 13; two explicit ones; the two largest.
@query("W03_stratified", W_RANKED + """, e as (select * from i where doc_id in (3, 8)), k as (select k.q, case when k.q <= 2 then 14 else 13 end - (select count(*) from e where quartile = k.q) as quota from (values (1), (2), (3), (4)) as k(q)),
 t as (select * from i where quartile = 4 and doc_id not in (3, 8) order by rank desc limit 2), taken as (select doc_id from e union all select doc_id from t),
 f as (select i.*, row_number() over (partition by quartile order by rank) - 1 as place, count(*) over (partition by quartile) as total from i where doc_id not in (select doc_id from taken)),
 w as (select q, quota - case when q = 4 then 2 else 0 end as needed from k),
 p as (select w.q, w.needed, cast(round_even(s.step * (x.total - 1) / (w.needed - 1.0::double), 0) as bigint) as place from w join (select distinct quartile, total from f) as x on x.quartile = w.q, generate_series(0, 13) as s(step) where s.step < w.needed),
 chosen as (select f.doc_id from f join p on p.q = f.quartile and p.place = f.place union all select doc_id from taken)
 select doc_id, n_chars, rank, quartile, cast(row_number() over (order by rank) as integer) as selection_rank from i where doc_id in (select doc_id from chosen)""")
def stratified(spark, sf_dir):
    return ranking.select_stratified(sizes(spark, sf_dir), "n_chars", "doc_id", 54, (3, 8)).select("doc_id", "n_chars", "rank", "quartile", "selection_rank")


def by_station(spark, sf_dir):
    return obs(spark, sf_dir).withColumn("n", F.col("STATION").cast("int") % 5).drop("DATE")


@query("S03_station_scan", W_OBS + " select lpad(cast(cast(STATION as integer) % 5 as varchar), 11, '0') as station_id, count(*) as n_rows, sum(obs_id)::bigint as sum_id from obs where cast(STATION as integer) % 5 in (0, 1, 2) group by all")
def station_scan(spark, sf_dir):
    """Five folders of which three have a station's name and the file."""
    root, df = folders.work_folder(spark, "scan"), by_station(spark, sf_dir)
    for n, name in enumerate(("00000000000/Raw.parquet", "00000000001/Raw.parquet", "00000000002/Raw.parquet", "0000-000003/Raw.parquet", "00000000004/Other.parquet")):
        df.where(F.col("n") == n).drop("n").write.mode("overwrite").parquet(f"{root}/{name}")
    found = folders.discover(spark, root, "Raw.parquet").where("size_bytes > 0").select("station_id")
    rows = folders.scan(spark, root, "Raw.parquet").groupBy("station_id").agg(F.count("*").alias("n_rows"), F.sum("obs_id").alias("sum_id"))
    return rows.join(found, "station_id")


@query("S11_csv_to_parquet", W_OBS + """ select lpad(cast(cast(STATION as integer) % 5 as varchar), 11, '0') as station_id, cast(obs_id as varchar) as obs_id, TMP, case when cast(STATION as integer) % 5 <> 0 then WND end as WND,
 case when cast(STATION as integer) % 5 = 2 then AA1 end as AA1 from obs where cast(STATION as integer) % 5 in (0, 1, 2)""")
def csv_to_parquet(spark, sf_dir):
    """Three stations' CSV files with unlike headers become one Parquet table."""
    root, df = folders.work_folder(spark, "csv"), by_station(spark, sf_dir)
    for n, columns in enumerate((["obs_id", "TMP"], ["WND", "TMP", "obs_id"], ["obs_id", "AA1", "WND", "TMP"])):
        df.where(F.col("n") == n).select(*columns).write.mode("overwrite").csv(f"{root}/raw/0000000000{n}/Raw.csv", header=True)
    return folders.convert_csv(spark, f"{root}/raw", "Raw.csv", f"{root}/parquet").select("station_id", "obs_id", "TMP", "WND", "AA1")


W_PIECES = W_TMP + """, p as (select *, len(string_split(VIS, ',')) = 4 and string_split(VIS, ',')[1] <> '999999' as seen, least(cast(string_split(VIS, ',')[1] as double), 160000) as v from tmp)"""


@query("S05_aligned", W_PIECES + """ select obs_id, case when obs_id % 3 <> 2 then round(temperature_c, 6) end as temperature_c, case when obs_id % 3 <> 0 and seen then v end as visibility_m, case when obs_id % 3 = 0 then cast(obs_id as double) when obs_id % 3 = 2 then 0.5 end as mark,
 case obs_id % 3 when 0 then pass::integer when 1 then pass::integer + seen::integer else seen::integer end as usable_metric_count, case obs_id % 3 when 0 then pass::integer when 1 then pass::integer + seen::integer else seen::integer end / 2.0::double as usable_metric_fraction from p""")
def aligned(spark, sf_dir):
    """Three pieces: temperature, both, visibility; a whole number in the first, a fraction in the last."""
    df = obs(spark, sf_dir)
    part = lambda k, *columns: cleaning.clean(df.where(F.col("obs_id") % 3 == k).select("obs_id", *columns))
    pieces = [part(0, "TMP", F.col("obs_id").alias("mark")), part(1, "TMP", "VIS"), part(2, "VIS", F.lit(0.5).alias("mark"))]
    x = schemas.aligned(pieces)
    return rounded(x.select("obs_id", "temperature_c", "visibility_m", "mark", "usable_metric_count", "usable_metric_fraction"), "temperature_c", to=6)


@query("G46_schema_consistency", """select * from (values ('00000000001', 3, '', 'WND', false), ('00000000002', 1, 'TMP', '', false), ('00000000003', 2, '', '', true)) as t(station_id, n_columns, missing, added, reordered)""")
def schema_consistency(spark, sf_dir):
    """Stations with one column more, one fewer, and the columns in another order."""
    root, df = folders.work_folder(spark, "schemas"), by_station(spark, sf_dir)
    for n, columns in enumerate((["obs_id", "TMP"], ["obs_id", "TMP", "WND"], ["obs_id"], ["TMP", "obs_id"], ["obs_id", "TMP"])):
        df.where(F.col("n") == n).select(*columns).coalesce(1).write.mode("overwrite").parquet(f"{root}/0000000000{n}")
    rows = folders.schema_rows(folders.contents(spark, root)).select(F.substring("path", 1, 11).alias("station_id"), "columns")
    out = folders.schema_deviations(rows, "station_id")
    return out.select("station_id", "n_columns", F.array_join("missing", ",").alias("missing"), F.array_join("added", ",").alias("added"), "reordered")


@query("G44_conformance", "select cast(artifact_id as varchar) as artifact_id, case when artifact_id % 7 = 3 then 'altered' else 'ok' end as state from (select distinct s_nationkey as artifact_id from supplier) union all select 'none', 'missing'")
def conformance(spark, sf_dir):
    """Suppliers' rows are written by nation; of some the manifest has another checksum, and of one it has no file."""
    root = folders.work_folder(spark, "artifacts")
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    s.select("s_nationkey", F.concat_ws("|", "s_suppkey", "s_name").alias("line")).repartition("s_nationkey").sortWithinPartitions("line").write.mode("overwrite").partitionBy("s_nationkey").text(f"{root}/files")
    found = folders.digests(folders.contents(spark, f"{root}/files").where(F.col("path").endswith(".txt")))
    key = F.regexp_extract("path", "s_nationkey=([^/]+)/", 1)
    manifest = found.select(key.alias("artifact_id"), "path", F.when(key.cast("int") % 7 == 3, F.sha2("checksum", 256)).otherwise(F.col("checksum")).alias("checksum"))
    manifest = manifest.unionAll(found.limit(1).select(F.lit("none"), F.lit("nowhere.txt"), "checksum"))
    manifest.write.mode("overwrite").parquet(f"{root}/manifest")
    return folders.conformance(spark.read.parquet(f"{root}/manifest"), found).select("artifact_id", "state")


FAMILY_COUNT = "count(*) filter (x.reason = '{0}') as {1}"


@query("S12_merged_profiles", W_VERDICTS + f""", c as (select STATION, {FAMILY_COUNT.format('SENTINEL_MISSING', 'sentinel_handling')}, {FAMILY_COUNT.format('BAD_QUALITY_CODE', 'quality_code_handling')}, count(*) filter (x.reason in ('OUT_OF_RANGE')) as range_validation,
  count(*) filter (x.reason = 'MALFORMED_TOKEN') as width_validation, count(*) filter (x.reason is not null and x.identifier = 'TMP') as flags_tmp, count(*) filter (x.reason is not null and x.identifier = 'VIS') as flags_vis from vd group by STATION),
 n as (select STATION, count(*) as rows_total, count(*) filter (temperature_c is null) as null_tmp, count(*) filter (len(string_split(VIS, ',')) <> 4 or string_split(VIS, ',')[1] = '999999') as null_vis from tmp group by STATION)
 select STATION, rows_total, nullif(null_tmp, 0) as null_tmp, nullif(null_vis, 0) as null_vis, nullif(flags_tmp, 0) as flags_tmp, nullif(flags_vis, 0) as flags_vis, sentinel_handling, quality_code_handling, range_validation, width_validation, rows_total as domain_validation, rows_total as structural_validation,
  0::bigint as arity_validation from n join c using (STATION)""")
def merged_profiles(spark, sf_dir):
    """Profiles by station and half are written as JSON, read again and merged by station."""
    df = obs(spark, sf_dir)
    identifiers = ["TMP", "WND", "VIS", "AA1"]
    x = cleaning.clean(df.withColumn("half", F.col("obs_id") % 2))
    texts = profiles.to_json(profiles.full_profile(x, identifiers, ["STATION", "half"]), ["STATION", "half"])
    p = profiles.merge(profiles.from_json(texts, ["STATION", "half"]), ["STATION"])
    at = lambda m, *names: [F.col(m)[k].alias(a) for k, a in names]
    families = ["sentinel_handling", "quality_code_handling", "range_validation", "width_validation", "domain_validation", "structural_validation", "arity_validation"]
    return p.select("STATION", "rows_total", *at("null_counts_by_identifier", ("TMP", "null_tmp"), ("VIS", "null_vis")), *at("qc_flag_counts_by_identifier", ("TMP", "flags_tmp"), ("VIS", "flags_vis")), *at("rule_family_impact_counts", *[(f, f) for f in families]))


W_RATES = W_TMP + """, s as (select STATION, count(*) as n, count(temperature_c) / count(*) as ct, count(AA1) / count(*) as ca, count(*) filter (reason = 'SENTINEL_MISSING') / count(*) as sr, count(*) filter (reason = 'BAD_QUALITY_CODE') / count(*) as er,
  (count(*) filter (reason = 'SENTINEL_MISSING') + count(*) filter (string_split(VIS, ',')[1] = '999999')) / count(*) as se from tmp group by STATION), m as (select STATION, month(DATE) as month, count(temperature_c) / count(*) as r from tmp group by all),
 v as (select 'field_completeness_ratio' as name, ct as value from s union all select 'field_completeness_ratio', ca from s union all select 'domain_usable_row_rate', ct from s union all select 'domain_usable_row_rate', ca from s union all select 'sentinel_row_rate', sr from s
  union all select 'quality_code_exclusion_rate', er from s union all select 'sentinel_events_per_row', se from s union all select 'station_year_usable_row_rate', r from m),
 dist as (select 'distribution' as section, name, 0 as place, null::varchar as subject, count(*) as n, min(value) as low, max(value) as high, avg(value) as mean, quantile_cont(value, 0.05) as p05, quantile_cont(value, 0.25) as p25, quantile_cont(value, 0.5) as median, quantile_cont(value, 0.75) as p75, quantile_cont(value, 0.95) as p95 from v group by name),
 top as (select 'list', 'top_sentinel_stations', row_number() over (order by sr desc, STATION) as place, STATION, 1, sr, sr, sr, null, null, null, null, null from s order by sr desc, STATION limit 10),
 bottom as (select 'list', 'lowest_field_completeness', row_number() over (order by c, STATION, field) as place, STATION || '|' || field, 1, c, c, c, null, null, null, null, null from (select STATION, 't' as field, ct as c from s union all select STATION, 'AA1', ca from s) order by c, STATION, field limit 10),
 al as (select * from dist union all select * from top union all select * from bottom)
 select section, name, place::integer as place, subject, n, round(low, 9) as low, round(high, 9) as high, round(mean, 9) as mean, round(p05, 9) as p05, round(p25, 9) as p25, round(median, 9) as median, round(p75, 9) as p75, round(p95, 9) as p95 from al"""


@query("G24_assessment", W_RATES)
def assessment(spark, sf_dir):
    df = with_tmp(obs(spark, sf_dir)).withColumn("month", F.month("DATE"))
    fields = quality.completeness(df, ["t", "AA1"])
    domains = reports.domain_usability(df, {"temperature": ["t"], "precipitation": ["AA1"]}, ["STATION"])
    lost = F.count_if(F.col("x.qc.reason") == "SENTINEL_MISSING")
    rates = df.groupBy("STATION").agg((lost / F.count("*")).alias("sentinel_row_rate"), ((lost + F.count_if(d.token(F.col("VIS"), 1) == "999999")) / F.count("*")).alias("sentinel_events_per_row"), (F.count_if(F.col("x.qc.reason") == "BAD_QUALITY_CODE") / F.count("*")).alias("quality_code_exclusion_rate"))
    months = df.groupBy("STATION", "month").agg((F.count("t") / F.count("*")).alias("usable_row_rate"))
    tables = {"field_completeness_ratio": (fields, "completeness"), "domain_usable_row_rate": (domains, "usable_rate"), "station_year_usable_row_rate": (months, "usable_row_rate")} | {c: (rates, c) for c in ("sentinel_row_rate", "sentinel_events_per_row", "quality_code_exclusion_rate")}
    lists = {"top_sentinel_stations": (rates, "sentinel_row_rate", ["STATION", "sentinel_row_rate"], False), "lowest_field_completeness": (fields, "completeness", ["STATION", "field", "completeness"], True)}
    return rounded(quality.assessment(tables, lists), "low", "high", "mean", *quality.MARKS)


MIXED = """select c_custkey as ID, case when c_custkey % 3 = 0 then '+' || cast(c_custkey as {text}) || '.5' when c_custkey % 3 = 1 then 'n/a' else null end as level, case when c_custkey % 2 = 0 then 'north' else 'south' end as side,
 cast(c_custkey % 9 as {text}) as WND__quality, cast(c_custkey % 24 as {text}) as precip_period_hours_1, cast(c_custkey % 90 as {text}) as precip_amount_1, c_acctbal as balance from {customer}"""


@query("V43_typed_columns", f"with m as ({MIXED.format(text='varchar', customer='customer')})" + " select ID, case when ID % 3 = 0 then cast(level as double) end as level, side, cast(precip_amount_1 as double) as precip_amount_1, balance from m")
def typed_columns(spark, sf_dir):
    """Quality codes and the period, whose class is drop, go; texts that hold numbers become numbers."""
    df = spark.sql(MIXED.format(text="string", customer="{customer}"), customer=spark.read.parquet(f"{sf_dir}/customer.parquet"))
    return schemas.drop_metadata(schemas.coerce_numeric(df, ["ID"]))


@query("T01_incremental", W_TMP + " select obs_id, round(temperature_c, 6) as temperature_c, reason from tmp")
def arriving(spark, sf_dir):
    """Files arrive in two lots; the stream takes what is there, goes on from its checkpoint, and runs once more with nothing new."""
    root, df = folders.work_folder(spark, "arriving"), obs(spark, sf_dir).select("obs_id", "TMP")
    for k in (0, 1, None):
        if k is not None:
            df.where(F.col("obs_id") % 2 == k).write.mode("append").parquet(f"{root}/in")
        rows = incremental.clean_arriving(spark, f"{root}/in", df.schema, ["TMP"])
        incremental.run_available(rows, f"{root}/out", f"{root}/state")
    return rounded(spark.read.parquet(f"{root}/out").select("obs_id", "tmp_.temperature_c", "tmp_.temperature_c_qc.reason"), "temperature_c", to=6)


W_DAYS = f"with e as ({OBS.format(text='varchar', events='events')}), w as (select STATION, DATE, string_split(TMP, ',')[1] <> '+9999' as ok from e), m as (select max(DATE) - interval 1 day as mark from w)"


@query("T02_running_quality", W_DAYS + " select STATION, date_trunc('day', DATE)::timestamp as day, count(*) as n_rows, count(*) filter (ok) as n_usable from w, m where date_trunc('day', DATE) + interval 1 day <= mark group by all")
def running(spark, sf_dir):
    """All rows, then the rows of whole closed days once more, which come too late to count."""
    root, df = folders.work_folder(spark, "running"), obs(spark, sf_dir).select("STATION", "DATE", (d.token(F.col("TMP"), 1) != "+9999").alias("ok"))
    last = df.agg((F.max("DATE") - F.expr("interval 1 day")).alias("mark"))
    closed = df.join(F.broadcast(last), F.date_trunc("day", "DATE") + F.expr("interval 1 day") <= F.col("mark")).drop("mark")
    for rows in (df, closed):
        rows.write.mode("append").parquet(f"{root}/in")
        counted = incremental.running_quality(spark.readStream.schema(df.schema).parquet(f"{root}/in"), "ok")
        incremental.run_available(counted, f"{root}/out", f"{root}/state")
    return spark.read.parquet(f"{root}/out").select("STATION", "day", "n_rows", "n_usable")
