"""Registered queries on gates of publication, tables in and out, and rules that had no row of their own, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsmill.functions.identifiers import class_of
from obsmill.operators import cleaning, climate, publication
from obsmill.queries import W_LONG, W_OBS, W_TMP, obs, obs_long, query, rounded
from obsmill.sources import folders, tables

#: A cleaned table of which some values are their column's scaled sentinel.
LEAKS = """select event_id % 5 as station, case when event_id % 11 = 0 then 999.9 else value end as temperature_c, case when event_id % 7 = 0 then 999999.0 when event_id % 13 = 0 then 9999.0 else value end as visibility_m,
 case when event_id % 3 = 0 then 999.0 else 180.0 end as wind_direction_deg, 999.9 as precip_amount_1 from {events}"""


@query("V14_leaks_by_rule", f"with l as ({LEAKS.format(events='events')}), f as (select station, 'temperature_c' as field, count(*) filter (event_id % 11 = 0) as n_leaks from (select event_id % 5 as station, event_id from events) group by station"
 " union all select station, 'visibility_m', count(*) filter (event_id % 7 = 0) from (select event_id % 5 as station, event_id from events) group by station union all select station, 'wind_direction_deg', count(*) filter (event_id % 3 = 0) from (select event_id % 5 as station, event_id from events) group by station) select * from f where n_leaks > 0")
def leaks_by_rule(spark, sf_dir):
    """Precipitation is of a family told by its first letters, which isn't asked."""
    df = spark.sql(LEAKS, events=spark.read.parquet(f"{sf_dir}/events.parquet")).withColumns({c: F.col(c).cast("double") for c in ("temperature_c", "visibility_m", "wind_direction_deg", "precip_amount_1")})
    return publication.sentinel_leaks(df, ["station"])


MARKED = """select event_id as obs_id, cast(event_id % 4 as int) as station, case event_id % 5 when 0 then '+0180,3' when 1 then '+0180,7' when 2 then '+9999,9' else '+0180,1' end as TMP,
 case event_id % 3 when 0 then '180,1,N,0050,3' when 1 then '180,7,N,0050,1' else '180,1,N,0050,1' end as WND from {events}"""


@query("V40_all_fields", "select event_id as obs_id, case when event_id % 5 in (3, 4) then 18.0::double end as temperature_c, case when event_id % 3 <> 1 then 180.0::double end as wind_direction_deg, case when event_id % 3 <> 0 then 5.0::double end as wind_speed_ms from events")
def all_suspects(spark, sf_dir):
    x = cleaning.clean(spark.sql(MARKED, events=spark.read.parquet(f"{sf_dir}/events.parquet")))
    return rounded(publication.null_suspects(x, ["TMP", "WND"]).select("obs_id", "temperature_c", "wind_direction_deg", "wind_speed_ms"), "temperature_c", "wind_speed_ms", to=6)


@query("G28_suspects_and_nulls", """with e as (select cast(event_id % 4 as integer) as station, event_id as e from events) select station, 'temperature_c' as field, count(*) filter (e % 5 in (0, 1)) as n_suspect, count(*) filter (e % 5 = 2) as n_null_before, count(*) filter (e % 5 in (0, 1, 2)) as n_null_after from e group by station
 union all select station, 'wind_speed_ms', count(*) filter (e % 3 = 0), 0, count(*) filter (e % 3 = 0) from e group by station union all select station, 'wind_direction_deg', count(*) filter (e % 3 = 1), 0, count(*) filter (e % 3 = 1) from e group by station""")
def suspects_and_nulls(spark, sf_dir):
    x = cleaning.clean(spark.sql(MARKED, events=spark.read.parquet(f"{sf_dir}/events.parquet")))
    return publication.suspects(x, ["TMP", "WND"], ["station"]).where(F.col("field").isin("temperature_c", "wind_speed_ms", "wind_direction_deg"))


@query("V06_allowed_by_part", "select event_id as obs_id, case event_id % 4 when 0 then 18.0::double when 3 then 18.0::double end as temperature_c, case event_id % 4 when 1 then 'BAD_QUALITY_CODE' when 2 then 'BAD_QUALITY_CODE' end as reason, case when event_id % 4 in (0, 2) then 50.0::double end as wind_gust_ms from events")
def allowed_by_part(spark, sf_dir):
    """Codes allowed for air temperature (also letters) and for gusts (mandatory ones and manual letters) differ by the rules of their parts."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("obs_id"), (F.col("event_id") % 4).alias("k"))
    cell = lambda value, codes: F.concat(F.lit(f"{value},"), F.element_at(F.array(*map(F.lit, codes)), (F.col("k") + 1).cast("int")))
    x = cleaning.clean(e.withColumns({"TMP": cell("+0180", ["C", "8", "Z", "1"]), "OC1": cell("0500", ["1", "8", "M", "X"])}))
    return rounded(x.select("obs_id", "temperature_c", F.col("TMP__qc_reason").alias("reason"), "wind_gust_ms"), "temperature_c", "wind_gust_ms", to=6)


@query("V22_classes", "select t.field, t.class, e.n as n_values from (values ('temperature_c', 'temperature'), ('dew_point_c', 'dew_point'), ('wind_speed_ms', 'wind'), ('sea_level_pressure_hpa', 'pressure'), ('visibility_m', 'visibility_ceiling'), ('precip_amount_1', 'precipitation'), ('TMP__qc_pass', 'temperature')) as t(field, class), (select count(*) as n from events) as e")
def classes(spark, sf_dir):
    """Classes of columns of a cleaned table, by their names, with the values that the columns hold."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    cells = {"TMP": "+0180,1", "DEW": "+0180,1", "WND": "180,1,N,0050,1", "SLP": "10132,1", "VIS": "010000,1,N,1", "AA1": "01,0010,9,1"}
    x = cleaning.clean(e.select(*[F.lit(v).alias(k) for k, v in cells.items()]))
    wanted = ["temperature_c", "dew_point_c", "wind_speed_ms", "sea_level_pressure_hpa", "visibility_m", "precip_amount_1", "TMP__qc_pass"]
    counts = x.agg(*[F.count(c).alias(c) for c in wanted])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.lit(class_of(c)).alias("class"), F.col(c).alias("n_values")) for c in wanted])))


@query("V23_caps", "select event_id as obs_id, least(event_id % 100000, 22000)::double as ceiling_height_m, least((event_id % 1000) * 999, 160000)::double as visibility_m from events where event_id % 100000 not in (99999) and (event_id % 1000) * 999 <> 999999")
def caps(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id % 100000 <> 99999 and (event_id % 1000) * 999 <> 999999")
    digits = lambda x, n: F.lpad(x.cast("string"), n, "0")
    x = e.select(F.col("event_id").alias("obs_id"), F.concat(digits(F.col("event_id") % 100000, 5), F.lit(",1,C,N")).alias("CIG"), F.concat(digits(F.col("event_id") % 1000 * 999, 6), F.lit(",1,N,1")).alias("VIS"))
    return cleaning.clean(x).select("obs_id", "ceiling_height_m", "visibility_m")


W_STATUS = """with s as (select o_orderpriority as batch, case when o_orderkey % 50 = 0 then 'skipped: empty' when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' then 'running' else 'pending' end as status,
 cast(round(o_totalprice * 100) as bigint) as size_bytes, cast(o_custkey % 600 as double) as elapsed_seconds from orders)"""


def statuses(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    status = F.when(F.col("o_orderkey") % 50 == 0, "skipped: empty").when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "running").otherwise("pending")
    return o.select(F.col("o_orderpriority").alias("batch"), status.alias("status"), F.round(F.col("o_totalprice") * 100).cast("long").alias("size_bytes"), (F.col("o_custkey") % 600).cast("double").alias("elapsed_seconds"))


@query("G38_terminal_state", W_STATUS + """, g as (select batch, status, size_bytes from s union all select 'done', 'completed', 0 from s where status = 'completed' union all select 'broken', case when status = 'running' then 'failed' else status end, 0 from s)
 select batch, count(*) as total, count(*) filter (status = 'completed') as completed, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'retrying') as retrying, count(*) filter (status = 'running') as running, count(*) filter (status = 'pending') as pending,
  count(*) filter (starts_with(status, 'skipped')) as skipped, count(*) filter (status = 'interrupted') as interrupted, bool_and(status = 'completed') as finalizable, case when bool_and(status = 'completed') then 'completed' when bool_or(status = 'failed') then 'failed' else 'interrupted' end as state from g group by batch""")
def terminal_states(spark, sf_dir):
    s = statuses(spark, sf_dir).select("batch", "status")
    done = s.where("status = 'completed'").withColumn("batch", F.lit("done"))
    broken = s.select(F.lit("broken").alias("batch"), F.when(F.col("status") == "running", "failed").otherwise(F.col("status")).alias("status"))
    return publication.terminal_state(s.unionByName(done).unionByName(broken), ["batch"])


@query("G39_batch_progress", W_STATUS + """, p as (select batch, count(*) as n_stations, count(*) filter (status = 'completed') as n_completed, sum(size_bytes)::bigint as bytes_total, coalesce(sum(size_bytes) filter (status = 'completed'), 0)::bigint as bytes_completed,
  avg(elapsed_seconds) filter (status = 'completed') as mean_seconds, quantile_cont(elapsed_seconds, 0.5) filter (status = 'completed') as median_seconds, sum(elapsed_seconds) filter (status = 'completed') as spent from s group by batch)
 select batch, n_stations, n_completed, bytes_total, bytes_completed, round(mean_seconds, 6) as mean_seconds, round(median_seconds, 6) as median_seconds, round(n_completed / n_stations, 9) as fraction_stations, round(bytes_completed / bytes_total, 9) as fraction_bytes,
  round((n_stations - n_completed) * mean_seconds, 4) as left_by_mean, round((n_stations - n_completed) * median_seconds, 4) as left_by_median, round((bytes_total - bytes_completed) * spent / bytes_completed, 4) as left_by_bytes from p""")
def batch_progress(spark, sf_dir):
    out = rounded(publication.progress(statuses(spark, sf_dir), ["batch"]), "mean_seconds", "median_seconds", to=6)
    return rounded(rounded(out, "fraction_stations", "fraction_bytes"), "left_by_mean", "left_by_median", "left_by_bytes", to=4)


@query("G41_ratio_checks", "select 'discount' as name, bool_and(coalesce(l_discount between 0 and 1, false)) as within from lineitem union all select 'quantity', bool_and(coalesce(l_quantity between 0 and 1, false)) from lineitem union all select 'absent', false union all select 'no_rows', true union all select 'text', false")
def ratio_checks(spark, sf_dir):
    x = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return publication.ratio_bounds({"discount": (x, "l_discount"), "quantity": (x, "l_quantity"), "absent": (x, "rate"), "no_rows": (x.where("l_quantity < 0"), "l_quantity"), "text": (x, "l_returnflag")})



@query("G42_manifest_faults", """with m as (select o_custkey as artifact_id, case when o_orderkey % 9 = 0 then strftime(o_orderdate, '%Y-%m-%d') when o_orderkey % 10 = 0 then 'soon' else strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') end as t from orders where o_orderkey % 3 = 0)
 select 'missing_column' as fault, 'checksum' as subject, 1::bigint as n union all select 'duplicate_id', cast(artifact_id as varchar), count(*) from m group by artifact_id having count(*) > 1 union all select 'timestamp', cast(artifact_id as varchar), count(*) from m where t not like '%T%' group by artifact_id""")
def manifest_faults(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderkey % 3 = 0")
    t = F.when(F.col("o_orderkey") % 9 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("o_orderkey") % 10 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return publication.manifest_faults(o.select(F.col("o_custkey").alias("artifact_id"), F.lit("x").alias("artifact_type"), F.lit("p").alias("artifact_path"), F.lit("[]").alias("input_lineage"), t.alias("creation_timestamp")))


W_ROWTEXT = """with r as (select s_nationkey, sha256(length(cast(s_suppkey as varchar)) || ':' || cast(s_suppkey as varchar) || ';' || case when s_suppkey % 4 = 0 then 'n;' else length(s_name) || ':' || s_name || ';' end) as h from supplier),
 l as (select s_nationkey, count(*) as n_rows, """ + ", ".join(f"cast(sum(cast('0x' || substr(h, {1 + 15 * k}, 15) as bigint)::hugeint) as varchar) as s{k}" for k in range(4)) + " from r group by s_nationkey)"


@query("G43_checksums", W_ROWTEXT + " select s_nationkey, n_rows, sha256(n_rows || '|' || s0 || '|' || s1 || '|' || s2 || '|' || s3) as checksum from l")
def checksums(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").withColumn("s_name", F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")))
    return publication.checksums(s, "s_nationkey", ["s_suppkey", "s_name"])


W_LINEAGE = """with m as (select 'raw_source/' || n_nationkey as artifact_id, 'raw_source' as artifact_type, [] as refs from nation union all select 'canonical_dataset/' || s_suppkey, 'canonical_dataset', case when s_suppkey % 5 = 0 then ['note'] else ['raw_source/' || (s_nationkey + case when s_suppkey % 7 = 0 then 100 else 0 end)] end from supplier
  union all select 'quality_report/' || s_suppkey, 'quality_report', ['canonical_dataset/' || s_suppkey, 'raw_source/0'] from supplier where s_suppkey % 3 = 0 union all select 'domain_dataset/' || s_suppkey, 'domain_dataset', ['canonical_dataset/' || s_suppkey] from supplier where s_suppkey % 2 = 0),
 x as (select m.artifact_id, m.artifact_type, r.ref, k.artifact_type as of_type from (select artifact_id, artifact_type, unnest(refs) as ref from m) as r join m using (artifact_id, artifact_type) left join m as k on k.artifact_id = r.ref)"""


@query("J13_lineage_types", W_LINEAGE + """ select artifact_id, 'unresolved' as fault, ref as detail from x where of_type is null and ref <> 'note' union all select artifact_id, 'no_upstream', 'raw_source' from m where artifact_type = 'canonical_dataset' and artifact_id not in (select artifact_id from x where of_type = 'raw_source')
 union all select artifact_id, 'no_upstream', 'domain_dataset' from m where artifact_type = 'quality_report' and artifact_id not in (select artifact_id from x where of_type = 'domain_dataset')""")
def lineage_types(spark, sf_dir):
    s, n = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("supplier", "nation"))
    named = lambda kind, key: F.concat(F.lit(f"{kind}/"), F.col(key).cast("string"))
    row = lambda df, kind, key, *refs: df.select(named(kind, key).alias("artifact_id"), F.lit(kind).alias("artifact_type"), F.to_json(F.array_compact(F.array(*refs)).cast("array<string>")).alias("input_lineage"))
    source = F.concat(F.lit("raw_source/"), (F.col("s_nationkey") + F.when(F.col("s_suppkey") % 7 == 0, 100).otherwise(0)).cast("string"))
    canonical = named("canonical_dataset", "s_suppkey")
    m = row(n, "raw_source", "n_nationkey").unionAll(row(s, "canonical_dataset", "s_suppkey", F.when(F.col("s_suppkey") % 5 == 0, "note").otherwise(source)))
    m = m.unionAll(row(s.where("s_suppkey % 3 = 0"), "quality_report", "s_suppkey", canonical, F.lit("raw_source/0"))).unionAll(row(s.where("s_suppkey % 2 = 0"), "domain_dataset", "s_suppkey", canonical))
    return publication.lineage_faults(m)


@query("G45_six_checks", "select round(3 / 6.0, 9) as score, 3::bigint as n_passed")
def six_checks(spark, sf_dir):
    """Three of six pass: coverage by the manifest of nations, times of orders, and discounts within bounds; all stations' completion and checksums fail, build metadata lack."""
    o, x = spark.read.parquet(f"{sf_dir}/orders.parquet"), spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    s, n = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("supplier", "nation"))
    check = lambda df, name, passed: df.agg(passed.alias("passed")).select(F.lit(name).alias("name"), "passed")
    uncovered = s.join(n, s["s_nationkey"] == n["n_nationkey"], "left_anti")
    parts = [check(publication.terminal_state(statuses(spark, sf_dir), []), "run_completion", F.bool_and("finalizable")), check(uncovered, "artifact_manifest_coverage", F.count("*") == 0), check(o, "timestamp_validity", F.bool_and(F.col("o_orderdate").isNotNull()))]
    parts.append(check(publication.checksums(s, "s_nationkey", ["s_suppkey"]), "checksum_policy_conformance", F.bool_and(F.col("checksum") == "recorded")))
    parts.append(publication.ratio_bounds({"artifact_structural_sanity": (x, "l_discount")}).select("name", F.col("within").alias("passed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return rounded(publication.integrity(out), "score")


@query("J08_not_used_before", "select cast(c_custkey as varchar) as station_id from customer where c_custkey in (1, 7) or c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")
def not_used_before(spark, sf_dir):
    """Customers stand for stations, those with orders of status F for stations of earlier runs; 1 and 7 are asked for all the same."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    kind = F.when(F.col("o_orderstatus") == "F", "raw_source").otherwise("canonical_dataset")
    manifests = o.select(kind.alias("artifact_type"), F.concat(kind, F.lit("/"), F.col("o_custkey").cast("string")).alias("artifact_id"))
    return publication.not_used_before(spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("string").alias("station_id")), manifests, ["1", "7"])


@query("J03_valid_days", W_LONG + """, v as (select STATION, day from lng group by all having count(distinct hour) >= 2), k as (select lng.* from lng semi join v using (STATION, day)), w as (select STATION, year, month from k group by all having count(distinct day) >= 3)
 select STATION, year, month, count(*) as n_rows, count(distinct day) as n_days from k semi join w using (STATION, year, month) group by all""")
def valid_days(spark, sf_dir):
    """Hourly rows of days with two hours or more, in months with three such days or more."""
    df = obs_long(spark, sf_dir)
    hours = df.groupBy("STATION", "year", "month", "day").agg(F.countDistinct("hour").alias("n")).where("n >= 2")
    months = hours.groupBy("STATION", "year", "month").agg(F.count("*").alias("n")).where("n >= 3").select("STATION", "year", "month")
    kept = df.join(hours.select("STATION", "day"), ["STATION", "day"], "left_semi").join(months, ["STATION", "year", "month"], "left_semi")
    return kept.groupBy("STATION", "year", "month").agg(F.count("*").alias("n_rows"), F.countDistinct("day").alias("n_days"))


@query("S01_csv_scan", W_OBS + " select cast(obs_id as varchar) as obs_id, case when obs_id % 4 <> 0 then TMP end as TMP from obs")
def csv_scan(spark, sf_dir):
    root = folders.work_folder(spark, "csv-scan")
    obs(spark, sf_dir).select("obs_id", F.when(F.col("obs_id") % 4 == 0, "N/A").otherwise(F.col("TMP")).alias("TMP")).write.mode("overwrite").csv(root, header=True)
    return tables.read_csv(spark, root, ["obs_id", "TMP"])


@query("S02_parquet_scan", W_OBS + " select obs_id, case when obs_id % 2 = 0 then TMP end as TMP, case when obs_id % 2 = 1 then VIS end as VIS from obs")
def parquet_scan(spark, sf_dir):
    root, df = folders.work_folder(spark, "parquet-scan"), obs(spark, sf_dir)
    for k, c in enumerate(("TMP", "VIS")):
        df.where(F.col("obs_id") % 2 == k).select("obs_id", c).write.mode("overwrite").parquet(f"{root}/k={k}")
    return tables.read_parquet(spark, root).select("obs_id", "TMP", "VIS")


@query("S04_stacked_years", W_OBS + " select obs_id, TMP, null::varchar as VIS, 2001 as YEAR from obs where obs_id % 2 = 0 union all select obs_id, null, VIS, 2002 from obs where obs_id % 2 = 1")
def stacked_years(spark, sf_dir):
    df = obs(spark, sf_dir)
    return tables.stack_years({2002: df.where("obs_id % 2 = 1").select("obs_id", "VIS"), 2001: df.where("obs_id % 2 = 0").select("VIS", "TMP", "obs_id").drop("VIS")}).select("obs_id", "TMP", "VIS", "YEAR")


@query("S06_sorted_csv", "select cast(s_suppkey as varchar) as s_suppkey, case when s_suppkey % 5 <> 0 then printf('%.1f', s_acctbal) end as s_acctbal from supplier")
def sorted_csv(spark, sf_dir):
    """Balances with one decimal, empty for null; read back as text, where only empty cells are absent."""
    root = folders.work_folder(spark, "sorted-csv")
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    text = F.when(F.col("s_suppkey") % 5 != 0, tables.fixed(F.col("s_acctbal"), 1))
    tables.write_sorted(s.select("s_suppkey", text.alias("s_acctbal")), root, ["s_suppkey"], "csv")
    return tables.read_csv(spark, root, ["s_suppkey", "s_acctbal"], absent=("",))


@query("S07_sorted_parquet", "select s_nationkey, s_suppkey, s_name from supplier")
def sorted_parquet(spark, sf_dir):
    root = folders.work_folder(spark, "sorted-parquet")
    tables.write_sorted(spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_nationkey", "s_suppkey", "s_name"), root, ["s_nationkey", "s_suppkey"])
    return tables.read_parquet(spark, root)


@query("S09_domain_sinks", W_TMP + " select 'pressure_temperature' as domain, count(*) as n_rows, 4 as n_columns, '1' as schema_version, true as read_back from tmp union all select 'clouds_visibility', count(*), 4, '1', true from tmp union all select 'metadata', count(*), 3, '1', true from tmp")
def domain_sinks(spark, sf_dir):
    root = folders.work_folder(spark, "domains")
    x = cleaning.with_contract(cleaning.clean(obs(spark, sf_dir).select("STATION", "DATE", "TMP", "VIS")))
    m = cleaning.write_views(x, root)
    counts = None
    for r in m.select("domain", "path").collect():
        part = spark.read.parquet(r["path"]).agg(F.count("*").alias("found")).select(F.lit(r["domain"]).alias("domain"), "found")
        counts = part if counts is None else counts.unionAll(part)
    return m.join(counts, "domain").select("domain", "n_rows", F.size("columns").alias("n_columns"), "schema_version", (F.col("found") == F.col("n_rows")).alias("read_back"))


@query("S10_class_sinks", W_TMP + " select 'temperature' as class, count(*) as n_rows from tmp union all select 'visibility_ceiling', count(*) from tmp")
def class_sinks(spark, sf_dir):
    root = folders.work_folder(spark, "classes")
    x = cleaning.clean(obs(spark, sf_dir).select("STATION", "TMP", "VIS"))
    return cleaning.write_classes(x, root).where(F.col("class").isin("temperature", "visibility_ceiling")).select("class", "n_rows")


@query("V39_precipitation_view", W_OBS + """ select STATION as station_id, cast(obs_id as bigint) as obs_id, round(case when string_split(AA1, ',')[2] <> '9999' then cast(string_split(AA1, ',')[2] as double) * 0.1 end, 6) as precip_amount_1,
 case when string_split(AA1, ',')[1] <> '99' then cast(string_split(AA1, ',')[1] as double) end as precip_period_hours_1, string_split(AA1, ',')[2] <> '9999' as AA1__part2__qc_pass from obs""")
def precipitation_view(spark, sf_dir):
    x = cleaning.with_contract(cleaning.clean(obs(spark, sf_dir))).withColumn("DATE", F.col("obs_id"))
    return rounded(cleaning.view(x, "precipitation").withColumnRenamed("DATE", "obs_id"), "precip_amount_1", to=6)


@query("V39_visibility_view", W_OBS + """ select STATION as station_id, cast(obs_id as bigint) as obs_id, case when len(string_split(VIS, ',')) = 4 and string_split(VIS, ',')[1] <> '999999' then least(cast(string_split(VIS, ',')[1] as double), 160000) end as visibility_m,
 case when len(string_split(VIS, ',')) = 4 then string_split(VIS, ',')[1] <> '999999' end as VIS__part1__qc_pass from obs""")
def visibility_view(spark, sf_dir):
    x = cleaning.with_contract(cleaning.clean(obs(spark, sf_dir))).withColumn("DATE", F.col("obs_id"))
    return cleaning.view(x, "clouds_visibility").withColumnRenamed("DATE", "obs_id")


@query("V39_metadata_view", W_OBS + " select STATION as station_id, DATE, cast(year(DATE) as integer) as YEAR from obs")
def metadata_view(spark, sf_dir):
    return cleaning.view(cleaning.with_contract(cleaning.clean(obs(spark, sf_dir).select("STATION", "DATE", "TMP"))), "metadata")


@query("V39_remarks_view", W_OBS + " select STATION as station_id, DATE, case when obs_id % 2 = 0 then 'SYN' || obs_id end as remarks_text from obs")
def remarks_view(spark, sf_dir):
    """The text of remarks as a column of the cleaned table."""
    df = obs(spark, sf_dir).select("STATION", "DATE", "TMP", F.when(F.col("obs_id") % 2 == 0, F.concat(F.lit("SYN"), F.col("obs_id").cast("string"))).alias("remarks_text"))
    return cleaning.view(cleaning.with_contract(cleaning.clean(df)), "remarks")


@query("G31_completeness_filters", W_LONG + """, h as (select STATION, count(*) as n_rows from lng group by STATION), f as (select STATION, year, month from lng group by all having count(distinct day) >= 20), a as (select STATION, count(*) as after_months from lng semi join f using (STATION, year, month) group by STATION),
 y as (select STATION, year from (select distinct STATION, year, month from f) group by all having count(*) >= 12), b as (select STATION, count(*) as after_years from lng semi join f using (STATION, year, month) semi join y using (STATION, year) group by STATION)
 select STATION, n_rows, coalesce(after_months, 0) as after_months, coalesce(after_years, 0) as after_years from h left join a using (STATION) left join b using (STATION)""")
def completeness_filters(spark, sf_dir):
    """Rows before and after each completeness filter, by station."""
    df = obs_long(spark, sf_dir)
    months = df.groupBy("STATION", "year", "month").agg(F.count("*").alias("n"), F.countDistinct("day").alias("days"))
    full = months.withColumn("month_ok", F.col("days") >= 20)
    years = full.groupBy("STATION", "year").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("month_ok"), F.col("n")).otherwise(0)).alias("after_months"), F.count_if("month_ok").alias("months"))
    return years.groupBy("STATION").agg(F.sum("n").alias("n_rows"), F.sum("after_months").alias("after_months"), F.sum(F.when(F.col("months") >= 12, F.col("after_months")).otherwise(0)).alias("after_years"))


@query("G29_retention_dates", "select event_id % 5 as station, count(*) as n_raw, count(*) filter (event_id % 6 <> 0) as n_cleaned, count(*) filter (event_id % 6 = 0) as n_dropped, count(*) filter (event_id % 6 = 0 and event_id % 12 <> 0) as n_invalid_dates from events group by all")
def retention_dates(spark, sf_dir):
    """Rows kept by reading dates; of the others, those that have a date which can't be read."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    date = F.when(F.col("event_id") % 12 == 0, F.lit(None)).when(F.col("event_id") % 6 == 0, "soon").otherwise("20240105")
    raw = e.select((F.col("event_id") % 5).alias("station"), date.alias("DATE"))
    kept = climate.text_times(raw).groupBy("station").agg(F.count("*").alias("n_cleaned"))
    before = raw.groupBy("station").agg(F.count("*").alias("n_raw"), F.count("DATE").alias("dated"))
    return before.join(kept, "station", "left").select("station", "n_raw", F.coalesce("n_cleaned", F.lit(0)).alias("n_cleaned"), (F.col("n_raw") - F.coalesce("n_cleaned", F.lit(0))).alias("n_dropped"), (F.col("dated") - F.coalesce("n_cleaned", F.lit(0))).alias("n_invalid_dates"))
