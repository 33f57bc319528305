"""Quality rules with adaptive thresholds, in DataFrame functions only.

Per text the rules' measures are taken with built-in functions. Then, instead
of fixed cutoffs, each measure's bound is set by the documents themselves: a
mergeable quantile sketch (counts of logarithmic buckets, 0.05 % relative error,
nothing drawn) per language and source, merged to one per language and one
overall, gives the quartiles of each group; the bound is the
upper fence of the quartiles, ``FENCE`` spreads above the third, where a
spread is the interquartile range but at least the measure's ``FLOOR``. A group
with fewer than ``LEAST_ROWS`` rows uses its language's fence, then the overall
one. The bounds (one row a group) are joined back to the measures and decide.

A group's spread does not grow with the group, and the sketches are combined
before the shuffle, so a source with a third of all rows costs its partial
sketches only.

Edge cases: a null text has no words and fails the base rules; null languages
and sources are groups of their own; repeated rows get equal results; an empty
table gives an empty result; texts of any length are measured whole. Columns of
the input named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.quantiles import merge, quantiles, sketch
from larder.llm.common import stage

LEAST_WORDS = 50
REPEAT_PERCENT = 50
#: Measures under adaptive bounds and the least spread of each.
FLOOR = {"symbol_share": 0.02, "dup_line_share": 0.12, "repeat_share": 0.1, "word_length": 0.5}
FENCE = 4.0
LEAST_ROWS = 100
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words in three-word windows that stand twice or more.

    The windows are sorted by hash, then by their words (read only where hashes are
    equal), then place; neighbours with equal words are repeats. Sorted places then give
    the covered words: each place adds the words up to the next one, three at most.
    Words must have three elements at least.
    """

    def of(w: Column) -> Column:
        def window(i: Column) -> Column:
            three = [F.get(w, i + k) for k in range(3)]
            return F.struct(F.xxhash64(*three).alias("h"), *[t.alias(f"w{k}") for k, t in enumerate(three)], i.cast("long").alias("i"))

        windows = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), window))
        repeats = F.sort_array(_let(windows, lambda s: F.transform(F.filter(s, lambda v, k: _equal(s, v, k)), lambda v: v["i"])))
        return _let(repeats, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(3)), F.lit(3)).cast("long")),
            F.lit(0).cast("long"), lambda a, x: a + x))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(_let(words, of))


def _equal(s: Column, v: Column, k: Column) -> Column:
    """Whether a window's words are those of the one before or after it; the hash is compared first."""
    def same(other: Column) -> Column:
        equal = other["h"] == v["h"]
        for name in ("w0", "w1", "w2"):
            equal = equal & (other[name] == v[name])
        return F.coalesce(equal, F.lit(False))

    return same(F.get(s, k - 1)) | same(F.get(s, k + 1))


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the measures of ``text``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0)
    base = docs.select(*keep, text.alias("_t"), F.array_remove(F.split(text, BLANK), "").alias("_w"), lines.alias("_l"))
    n = F.size("_w").cast("long")
    counted = base.select(
        *keep, n.alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("_lines"),
        _repeated_words(F.col("_w")).alias("n_repeat_words"))
    some = F.greatest(F.col("n_words"), F.lit(1))
    return counted.select(
        "*",
        (F.col("n_symbols") / some).alias("symbol_share"),
        (F.col("n_dup_lines") / F.greatest(F.col("_lines"), F.lit(1))).alias("dup_line_share"),
        (F.col("n_repeat_words") / some).alias("repeat_share"),
        (F.col("word_chars") / some).alias("word_length"),
        ((F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
    ).drop("_lines")


def thresholds(measured: DataFrame) -> DataFrame:
    """(lang, source, limit_<measure>...) for every group, from merged quantile sketches.

    A sketch is counts of logarithmic buckets (``functions.quantiles``), one row
    a bucket that occurs: merging is a sum, so limits are the same whatever the
    partitioning and after any retried task.
    """
    values = F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in FLOOR]))
    stacked = measured.where(~F.col("base_failed")).select("lang", "source", values)
    own = stage(sketch(stacked, "value", ["lang", "source", "measure"]), "quality-sketches")
    by_lang, overall = merge(own.drop("source")), merge(own.drop("lang", "source"))
    groups = measured.select("lang", "source").distinct()
    floor = F.coalesce(*[F.when(F.col("measure") == m, F.lit(v)) for m, v in FLOOR.items()])
    fence = F.col("q3") + FENCE * F.greatest(F.col("q3") - F.col("q1"), floor)

    def fences(sketched: DataFrame, keys: list[str], tag: str, least: int) -> DataFrame:
        found = quantiles(sketched, [0.25, 0.75], ["q1", "q3"], count="n")
        limit = F.when(F.col("n") >= least, fence)
        return found.groupBy(*[F.col(k).alias(f"{tag}_{k}") for k in keys]).agg(
            *[F.max(F.when(F.col("measure") == m, limit)).alias(f"{tag}_{m}") for m in FLOOR])

    mine = fences(own, ["lang", "source"], "own", LEAST_ROWS)
    lang = fences(by_lang, ["lang"], "lang", LEAST_ROWS)
    whole = fences(overall, [], "all", 1)
    found = groups.join(mine, F.col("lang").eqNullSafe(F.col("own_lang")) & F.col("source").eqNullSafe(F.col("own_source")), "left")
    found = found.join(lang.withColumnRenamed("lang_lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    return found.select("lang", "source", *[
        F.coalesce(F.col(f"own_{m}"), F.col(f"lang_{m}"), whole.select(f"all_{m}").scalar()).alias(f"limit_{m}") for m in FLOOR])


def quality_filter(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (the id by default), measures, base_failed, limits and kept."""
    keep = keep or ["doc_id"]
    working = docs.select(*[F.col(k) for k in keep], F.col("lang").cast("string").alias("_lang"),
                          F.col("source").cast("string").alias("_source"), "text")
    measured = stage(measures(working, [*keep, "_lang", "_source"]), "quality")
    limits = thresholds(measured.select(F.col("_lang").alias("lang"), F.col("_source").alias("source"), "base_failed", *FLOOR))
    limits = limits.withColumnsRenamed({"lang": "_of_lang", "source": "_of_source"})
    same = F.col("_lang").eqNullSafe(F.col("_of_lang")) & F.col("_source").eqNullSafe(F.col("_of_source"))
    within = F.lit(True)
    for m in FLOOR:
        within &= F.coalesce(F.col(m) <= F.col(f"limit_{m}"), F.lit(True))
    return measured.join(limits, same, "left").withColumn("kept", ~F.col("base_failed") & within).drop(
        "_lang", "_source", "_of_lang", "_of_source")
