"""The same results in SQL (DuckDB's), for the operators that are plain arithmetic."""

from __future__ import annotations

#: Systematic sampling: targets by the level in closed form, places in the order by windows, copies where an integer is crossed.
MIXING = r"""
with s as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
o as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as rank from s group by source),
w as (select *, [5, 2, 1][rank % 3 + 1] as weight from o),
r as (select *, 3 * source_size / weight as ratio, cast(coalesce(sum(source_size) over before, 0) as bigint) as size_before, cast(coalesce(sum(weight) over before, 0) as bigint) as weight_before from w
 window before as (order by 3 * source_size / weight, rank rows between unbounded preceding and 1 preceding)),
l as (select *, (cast(sum(source_size) over () as bigint) - 3 * size_before) / (cast(sum(weight) over () as bigint) - weight_before) as level from r),
t as (select source, source_size, rank, least(weight * (select arg_min(level, (ratio, rank)) from l where level <= ratio), cast(3 * source_size as double)) as target from l),
b as (select *, floor(8 * log2(size + 1)) as band from s),
c as (select *, doc_id % cast(ceil(count(*) over (partition by source, band) / 20000) as bigint) as salt from b),
p as (select c.doc_id, c.size, t.*, row_number() over (partition by c.source order by band, salt, size, doc_id) - 1 as place, case when source_size > 0 then target / source_size else 0.0::double end as expected,
 floor((((rank + 1) * 0.6180339887498949::double) % 1.0::double) * 1048576) / 1048576.0::double as start from c join t on c.source is not distinct from t.source)
select doc_id, size, source_size, target, size * cast(floor(expected * (place + 1) + start) - floor(expected * place + start) as bigint) as taken from p
"""


def vector_codes(parts: int = 8, width: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain k-means of integer parts, all distances in each round. ``width``: components of a part."""
    distance = f"list_sum(list_transform(range(1, {width + 1}), lambda i: (x.xs[i] - c.ys[i]) * (x.xs[i] - c.ys[i])))"
    steps = [
        "kept as materialized (select vec_id, label, list_transform(embedding, lambda v: cast(floor(4096 * v::double) as bigint)) as v from embeddings where embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0)",
        f"x as materialized (select vec_id, label, part, v[part * {width} + 1 : part * {width} + {width}] as xs from kept, range({parts}) as p(part))",
        f"c0 as materialized (select part, row_number() over (partition by part order by vec_id) - 1 as entry, xs as ys from x where vec_id in (select vec_id from kept order by vec_id limit {entries}))",
    ]
    for k in range(rounds + 1):
        steps.append(f"a{k} as materialized (select vec_id, any_value(label) as label, part, min((d, entry)) as best, any_value(xs) as xs from (select x.*, c.entry, {distance} as d from x join c{k} as c using (part)) group by vec_id, part)")
        if k < rounds:
            steps.append(f"s{k} as (select part, best[2] as entry, i, cast(sum(xs[i]) as bigint) as total, count(*) as n from a{k}, range(1, {width + 1}) as r(i) group by all)")
            steps.append(f"m{k} as (select part, entry, list((total - ((total % n) + n) % n) // n order by i) as ys from s{k} group by part, entry)")
            steps.append(f"c{k + 1} as materialized (select c.part, c.entry, coalesce(m.ys, c.ys) as ys from c{k} as c left join m{k} as m on c.part = m.part and c.entry = m.entry)")
    steps.append(f"coded as (select vec_id, any_value(label) as label, string_agg(printf('%02x', best[2]), '' order by part) as code, cast(sum(best[1]) as bigint) as error from a{rounds} group by vec_id)")
    steps.append(f"book as (select sha256(string_agg(array_to_string(ys, ','), ',' order by part, entry)) as codebooks_sha256 from c{rounds})")
    return "with " + ",\n".join(steps) + "\nselect vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from coded, book"


def oracle_sql() -> dict[str, str]:
    return {"op9_mixing": MIXING, "op13_vector_codes": vector_codes()}
