"""Quality rules whose thresholds come from mergeable quantile sketches for each language and source.

Everything is DataFrame expressions. ``measures`` counts words, symbols, repeated lines and repeated windows
of a text without leaving its row. ``bounds`` sketches the rates of the documents that pass the base rule (KLL
sketches by language and source, merged upwards to languages and to all) and reads upper bounds off them:
``margin`` times an upper quantile of the group. Most rates are zero in most documents, so the quantile lies in the
tail; that of symbols lies lower, below the share of documents that are symbols for a tenth or more (5 to 15 % of a
group), as a quantile among these would let all of them pass. ``apply_bounds`` joins the bounds and keeps what lies
within all of them, or passes one by no more than the least count that can occur (``ROUNDING``): a single symbol,
repeated line or capital, or one repeated window.

Defined results: null text has no words and fails the base rule, as has text of white space alone. Null lang
and null source are groups of their own. A group with fewer than ``least`` documents that pass the base rule
takes its language's bounds, and a language with fewer those of all documents; without any, the base rule
alone decides. KLL sketches choose at random what they keep, so bounds of large groups can differ by the
sketch's rank error (under 1 % at k = 400) between runs. Repeated rows are each judged; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmill.llm import common

#: The characters that count as symbols, and the base rule's limits.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, WINDOW, REPEAT_PERCENT = 10, 5, 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The measured rates with the quantile that bounds them, what they are made of, and the least count that can occur.
TAIL = {"symbol_rate": 0.8, "dup_line_rate": 0.95, "repeat_rate": 0.95, "upper_rate": 0.95}
PARTS = {"symbol_rate": ("n_symbols", "word_chars"), "dup_line_rate": ("n_dup_lines", "n_lines"), "repeat_rate": ("n_repeat_words", "n_words"), "upper_rate": ("n_upper", "word_chars")}
ROUNDING = {"symbol_rate": 1, "dup_line_rate": 1, "repeat_rate": 2 * WINDOW, "upper_rate": 1}
BROADCAST_ROWS, SALTS = 100_000, 32


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and n_upper (A-Z)."""
    body = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(body, common.SPACES, "")
    lacks = lambda chars: (F.length("_bare") - F.length(F.translate("_bare", chars, ""))).cast("long")
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, common.SPACES, "")) > 0)
    df = docs.withColumns({
        "_bare": bare,
        "_w": F.transform(F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w)),
        "_l": F.transform(lines, lambda x: F.xxhash64(x)),
    })
    n = F.size("_w")
    df = df.withColumns({"_2": F.when(n >= WINDOW, F.zip_with(F.slice("_w", F.lit(1), n - 1), F.slice("_w", F.lit(2), n - 1), lambda a, b: F.xxhash64(a, b)))})
    df = df.withColumns({"_4": F.when(n >= WINDOW, F.zip_with(F.slice("_2", F.lit(1), n - 4), F.slice("_2", F.lit(3), n - 4), lambda a, b: F.xxhash64(a, b)))})
    df = df.withColumns({"_5": F.when(n >= WINDOW, F.zip_with(F.col("_4"), F.slice("_w", F.lit(5), n - 4), lambda a, b: F.xxhash64(a, b)))})
    some = F.size("_5") > F.size(F.array_distinct("_5"))
    df = df.withColumns({"_s": F.when(some, F.sort_array(F.zip_with(F.col("_5"), F.sequence(F.lit(0), F.size("_5") - 1), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))})
    m = F.size("_s")
    df = df.withColumns({"_e": F.when(F.col("_s").isNotNull(), F.zip_with(F.slice("_s", F.lit(1), m - 1), F.slice("_s", F.lit(2), m - 1), lambda a, b: a["h"] == b["h"]))})
    twice = F.zip_with(F.concat(F.array(F.lit(False)), "_e"), F.concat("_e", F.array(F.lit(False))), lambda a, b: a | b)
    starts = F.sort_array(F.filter(F.zip_with(F.col("_s"), twice, lambda x, d: F.when(d, x["i"])), lambda i: i.isNotNull()))
    zero = F.struct(F.lit(0).alias("to"), F.lit(0).alias("n"))
    covered = F.aggregate(starts, zero, lambda a, i: F.struct((i + WINDOW).alias("to"), (a["n"] + WINDOW - F.greatest(F.lit(0), a["to"] - i)).alias("n")), lambda a: a["n"])
    return df.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length("_bare").cast("long"),
        "n_symbols": lacks(SYMBOLS),
        "n_upper": lacks(UPPER),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": F.coalesce(F.when(F.col("_s").isNotNull(), covered), F.lit(0)).cast("long"),
    }).drop("_bare", "_w", "_l", "_2", "_4", "_5", "_s", "_e")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def rates() -> dict[str, Column]:
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return {x: ratio(*of) for x, of in PARTS.items()}


def bounds(measured: DataFrame, lang: str = "lang", source: str = "source", margin: float = 2.0, least: int = 50, k: int = 400) -> DataFrame:
    """(lang, source, one upper bound a rate), a row for every group of measured."""
    rows = measured.select(F.col(lang).alias("lang"), F.col(source).alias("source"), base_failed().alias("failed"), *[c.alias(x) for x, c in rates().items()])
    good = lambda x: F.when(~F.col("failed"), F.col(x))
    groups = rows.groupBy("lang", "source").agg(F.count(F.when(~F.col("failed"), 1)).alias("n"), *[F.kll_sketch_agg_double(good(x), k).alias(x) for x in TAIL])

    def merged(*by: str) -> DataFrame:
        return groups.where("n > 0").groupBy(*by).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(x, k).alias(x) for x in TAIL])

    def upper(x: str, at_least: int = least) -> Column:
        return F.when(F.col("n") >= at_least, margin * F.kll_sketch_get_quantile_double(F.col(x), F.lit(TAIL[x]))).alias(x)

    one = groups.select("lang", "source", *[upper(x) for x in TAIL]).alias("g")
    two = merged("lang").select("lang", *[upper(x) for x in TAIL]).alias("l")
    all_ = merged().select(*[upper(x, 1) for x in TAIL]).alias("a")
    joined = one.join(two, F.col("g.lang").eqNullSafe(F.col("l.lang")), "left").join(F.broadcast(all_), F.lit(True), "left")
    return joined.select("g.lang", "g.source", *[F.coalesce(f"g.{x}", f"l.{x}", f"a.{x}").alias(f"{x}_bound") for x in TAIL])


def apply_bounds(measured: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """measured with base_failed and kept. limits is broadcast while it has BROADCAST_ROWS rows or fewer, and salted beyond."""
    few = limits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    salt = F.lit(0) if few else F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    right = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"}).withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(0 if few else SALTS - 1))))
    on = F.col(lang).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source")) & (F.col("_salt") == F.col("_of"))
    out = measured.withColumn("_salt", salt).join(F.broadcast(right) if few else right, on, "left")
    within = F.lit(True)
    for x, (n, of) in PARTS.items():
        within = within & F.coalesce(F.col(n) <= F.col(f"{x}_bound") * F.col(of) + ROUNDING[x], F.lit(True))
    return out.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & within}).drop("_lang", "_source", "_of", "_salt")


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(doc_id, lang, source, the measures, the bounds, base_failed, kept) for each row of docs."""
    rows = measures(docs.select("doc_id", F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))).drop("text")
    held = common.Scratch(docs.sparkSession, "quality-rules").result(rows)
    limits = common.Scratch(docs.sparkSession, "quality-bounds").result(bounds(held))
    return apply_bounds(held, limits)
