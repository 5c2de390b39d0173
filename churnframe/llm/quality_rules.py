"""Operator 8, quality rules with adaptive thresholds.

Every document gets integer measures (words, symbols, repeats, ...).  Each
measure's distribution per language and source is summarised by a mergeable
quantile sketch: counts in buckets whose width is 1/32 of the value or less,
so partial sketches add up and the result does not depend on the order.  The
sketch's quartiles give fences ``q25 - K*spread`` and ``q75 + K*spread`` with
``spread = max(q75 - q25, margin)``; a document outside a fence is rejected.
The fixed base rules reject as well.

Defined results: null or blank text has no words and fails the base rules; a
null language or source counts as the empty string; groups of fewer than
``min_group`` documents use the merged sketch of all documents; repeated rows
are judged one by one (each gets the same verdict); an empty table gives an
empty result; extra columns are passed through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnframe.llm.common import fresh, materialize_as, maybe_broadcast
from churnframe.session import release

SPACE_RUN = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``value`` names the measure, ``margin`` its least spread; ``low`` says
    that small values are judged too."""
    value: str
    margin: int
    low: bool = False


#: hundredths of a character per word; then thousandths of words, lines,
#: words and word characters
RULES = (
    Rule("word_len", 50, low=True),
    Rule("symbol_rate", 50),
    Rule("dup_line_rate", 100),
    Rule("repeat_rate", 30),
    Rule("upper_rate", 60),
)
FENCE_K = 6
MIN_GROUP = 50
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus the five measures, ``n_upper`` and ``n_lines`` (long)."""
    words, lines, win, order, spots = fresh(df, ["w", "lines", "win", "ord", "spots"])
    t = F.coalesce(F.col(text), F.lit(""))
    out = (df.withColumn(words, F.array_remove(F.split(t, SPACE_RUN), ""))
             .withColumn(lines, F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_SPACE))))
    w = F.col(words)
    at = lambda i: F.get(w, i)
    out = out.withColumn(win, F.when(F.size(w) >= 5, F.transform(
        F.sequence(F.lit(0), F.size(w) - 5),
        lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2), at(i + 3), at(i + 4)))))
    h = F.col(win)
    # sorting (hash, position) brings equal windows together
    out = out.withColumn(order, F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    o = F.col(order)
    same = lambda e, k: F.coalesce(F.get(o, k)["h"] == e["h"], F.lit(False))
    out = out.withColumn(spots, F.sort_array(F.transform(
        F.filter(o, lambda e, k: same(e, k - 1) | same(e, k + 1)), lambda e: e["i"])))
    p = F.col(spots)
    covered = F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(p, k + 1) - x, F.lit(5)))),
        F.lit(0), lambda a, x: a + x)
    return out.select(
        *df.columns,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.size(lines).cast("long").alias("n_lines"))


def _rate(a: str, b: str, scale: int) -> Column:
    return F.when(F.col(b) > 0, F.expr(f"{a} * {scale}L div {b}")).otherwise(F.lit(0).cast("long"))


def rule_values() -> dict[str, Column]:
    return {"word_len": _rate("word_chars", "n_words", 100),
            "symbol_rate": _rate("n_symbols", "n_words", 1000),
            "dup_line_rate": _rate("n_dup_lines", "n_lines", 1000),
            "repeat_rate": _rate("n_repeat_words", "n_words", 1000),
            "upper_rate": _rate("n_upper", "word_chars", 1000)}


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))


def sketch(measured: DataFrame, lang: str, source: str) -> DataFrame:
    """Bucket counts per group and rule: (g_lang, g_source, rule, bucket, n)."""
    values = rule_values()
    rows = F.array(*[F.struct(F.lit(r.value).alias("rule"), values[r.value].alias("v"))
                     for r in RULES])
    long = measured.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("g_lang"),
                           F.coalesce(F.col(source).cast("string"), F.lit("")).alias("g_source"),
                           F.explode(rows).alias("r"))
    shift = F.greatest(F.lit(0), F.length(F.bin("r.v")) - 6)
    bucket = F.call_function("shiftleft", F.call_function("shiftright", F.col("r.v"), shift), shift)
    return (long.groupBy("g_lang", "g_source", F.col("r.rule").alias("rule"), bucket.alias("bucket"))
                .agg(F.count(F.lit(1)).alias("n")))


def _quartiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys)
    run = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select(*keys, "bucket", F.sum("n").over(run).alias("cum"),
                           F.sum("n").over(w).alias("total"))
    at = lambda q: F.min(F.when(F.col("cum") * 100 >= F.col("total") * q, F.col("bucket")))
    return ranked.groupBy(*keys).agg(F.max("total").alias("total"),
                                     at(25).alias("q25"), at(75).alias("q75"))


def thresholds(counts: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per group: a low and a high fence for each rule."""
    own = _quartiles(counts, ["g_lang", "g_source", "rule"])
    merged = counts.groupBy("rule", "bucket").agg(F.sum("n").alias("n"))
    pool = _quartiles(merged, ["rule"]).select(
        "rule", F.col("q25").alias("p25"), F.col("q75").alias("p75"))
    margin = F.coalesce(*[F.when(F.col("rule") == r.value, F.lit(r.margin)) for r in RULES])
    low = F.col("rule").isin([r.value for r in RULES if r.low])
    pick = lambda a, b: F.when(F.col("total") >= min_group, F.col(a)).otherwise(F.col(b))
    fenced = (own.join(pool, "rule")
                 .withColumn("a", pick("q25", "p25")).withColumn("b", pick("q75", "p75"))
                 .withColumn("spread", F.greatest(F.col("b") - F.col("a"), margin) * FENCE_K)
                 .withColumn("lo", F.when(low, F.col("a") - F.col("spread")))
                 .withColumn("hi", F.col("b") + F.col("spread")))
    return fenced.groupBy("g_lang", "g_source").agg(*[
        F.max(F.when(F.col("rule") == r.value, F.col(side))).alias(f"{r.value}_{side}")
        for r in RULES for side in ("lo", "hi")])


def _within() -> Column:
    """Every rule's value lies inside its fences."""
    values, ok = rule_values(), F.lit(True)
    for r in RULES:
        v = values[r.value]
        ok = ok & (v <= F.col(f"{r.value}_hi"))
        if r.low:
            ok = ok & (v >= F.col(f"{r.value}_lo"))
    return ok


def _with_fences(measured: DataFrame, fences: DataFrame, lang: str, source: str) -> DataFrame:
    """One row of fences per group, broadcast if counted small; else shuffled,
    where AQE splits a hot group."""
    keyed = (measured.withColumn("g_lang", F.coalesce(F.col(lang).cast("string"), F.lit("")))
                     .withColumn("g_source", F.coalesce(F.col(source).cast("string"), F.lit(""))))
    return keyed.join(maybe_broadcast(fences), ["g_lang", "g_source"], "left")


def _fences(measured: DataFrame, lang: str, source: str) -> DataFrame:
    return materialize_as(thresholds(sketch(measured, lang, source)), "quality-fences")


def judge(df: DataFrame, text: str = "text", lang: str = "lang",
          source: str = "source", carry: list[str] | None = None) -> DataFrame:
    """The columns in ``carry`` (all by default), the measures, ``base_failed``
    and ``kept``.  The measured rows are written once to the shared folder: the
    sketch and the verdicts both read them, so texts are measured once.  Carry
    narrow columns only; to filter whole rows use ``quality_filter``."""
    carry = list(df.columns) if carry is None else carry
    need = carry + [c for c in (lang, source) if c not in carry]
    names = {c: f"c{i}" for i, c in enumerate(need)}  # no clash with the measures
    plain = df.select(F.col(text).alias("text_"), *[F.col(c).alias(names[c]) for c in need])
    measured = materialize_as(measures(plain, "text_").drop("text_"), "quality-measures")
    joined = _with_fences(measured, _fences(measured, names[lang], names[source]), names[lang], names[source])
    return joined.select(*[F.col(names[c]).alias(c) for c in carry], *MEASURES,
                         base_failed().alias("base_failed"),
                         (~base_failed() & _within()).alias("kept"))


def quality_filter(df: DataFrame, text: str = "text", lang: str = "lang",
                   source: str = "source") -> DataFrame:
    """Rows of ``df`` that pass the base rules and the adaptive fences, with
    the columns of ``df``.  Only measures are written for the sketch; the
    verdicts measure the texts again, which spares a copy of all of them."""
    inner = [f"k{i}" for i in range(len(df.columns))]
    at = {c: inner[i] for i, c in enumerate(df.columns)}
    rows = df.toDF(*inner)
    narrow = materialize_as(measures(rows.select(at[text], at[lang], at[source]), at[text]).drop(at[text]),
                            "quality-measures")
    fences = _fences(narrow, at[lang], at[source])
    release(narrow)
    # the row number keeps the filter above the measures: pushed below, it would
    # evaluate them anew inside its own condition
    measured = measures(rows, at[text]).withColumn("row_", F.monotonically_increasing_id())
    joined = _with_fences(measured, fences, at[lang], at[source])
    return joined.filter((F.col("row_") >= 0) & ~base_failed() & _within()).select(*[F.col(at[c]).alias(c) for c in df.columns])
