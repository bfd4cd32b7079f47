"""Quality rules whose limits follow the documents of each language and source.

Every document gets a few measures. Their distributions are sketched per (language, source) as
log-linear histograms: values under 64 are kept, larger ones to 6 leading bits, so any quantile is
known to 1/32 and sketches merge by adding counts, in any order, with the same result. A limit lies
some quartile ranges and a fixed slack outside the quartiles, so that a group without
outliers loses nothing. A group with few documents takes the merged sketch of its language, or
that of all documents. Limits are joined to the documents; a hot source is one row on that side.

Null texts count as empty, null languages and sources are groups like any other, repeated
rows are judged one by one, an empty table gives an empty result. Added columns start with ``_q``;
other names in the table do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.llm.columns import fenced, same, words
from tallyframe.llm.storage import cut

MIN_WORDS = 50
#: Groups with fewer judged documents than this use a wider sketch.
MIN_GROUP = 200
#: Quartile ranges between a quartile and the limit.
REACH = 4
#: Measure: (numerator, denominator, scale, slack beyond the fence, also a lower limit).
MEASURES = {
    "_q_word_length": ("_q_word_chars", "_q_words", 100, 200, True),
    "_q_symbols": ("_q_n_symbols", "_q_words", 1000, 100, False),
    "_q_dup_lines": ("_q_n_dup_lines", "_q_lines", 1000, 500, False),
    "_q_repeats": ("_q_n_repeat_words", "_q_words", 1000, 200, False),
}


def score(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``_q_words, _q_lines, _q_word_chars, _q_n_symbols, _q_n_dup_lines``, and
    ``_q_n_repeat_words``: words in windows of three that occur twice or more in the text."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    names = df.columns
    out = fenced(df, _q_list=words(whole), _q_rows=lines,
                 _q_n_symbols=F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long"))
    every = F.col("_q_list")
    windows = F.transform(
        F.slice(every, F.lit(1), F.greatest(F.size(every) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(every, i + 1), F.get(every, i + 2)))
    kept = [F.col(f"`{c}`") for c in names]
    out = fenced(
        out, _q_windows=windows, _q_words=F.size(every).cast("long"),
        _q_lines=F.size("_q_rows").cast("long"),
        _q_n_dup_lines=(F.size("_q_rows") - F.size(F.array_distinct("_q_rows"))).cast("long"),
        _q_word_chars=F.char_length(F.array_join(every, "")).cast("long"))
    measured = ["_q_words", "_q_lines", "_q_word_chars", "_q_n_symbols", "_q_n_dup_lines"]
    found = F.col("_q_windows")
    pairs = F.when(
        F.size(F.array_distinct(found)) < F.size(found),
        F.sort_array(F.transform(found, lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    out = fenced(out.select(*kept, *measured, "_q_windows"), _q_pairs=pairs)
    sorted_ = F.col("_q_pairs")
    twice = F.filter(sorted_, lambda s, i: (
        F.coalesce(F.get(sorted_, i - 1)["x"] == s["x"], F.lit(False))
        | F.coalesce(F.get(sorted_, i + 1)["x"] == s["x"], F.lit(False))))
    out = fenced(out.select(*kept, *measured, "_q_pairs"),
                 _q_places=F.sort_array(F.transform(twice, lambda s: s["i"])))
    places = F.col("_q_places")
    steps = F.transform(places, lambda p, i: F.least(
        F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
    repeated = F.aggregate(steps, F.lit(0), lambda a, x: a + x)
    return out.select(*kept, *measured,
                      F.coalesce(repeated, F.lit(0)).cast("long").alias("_q_n_repeat_words"))


def base_failed() -> Column:
    return (F.col("_q_words") < MIN_WORDS) | (
        100 * F.col("_q_n_repeat_words") > 50 * F.col("_q_words"))


def _measures() -> dict[str, Column]:
    return {name: F.coalesce(F.expr(f"({scale} * {a}) div nullif({b}, 0)"), F.lit(0).cast("long"))
            for name, (a, b, scale, _, _) in MEASURES.items()}


def sketch(scored: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, measure, bin, n)`` of the documents that pass the base rules."""
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), c.alias("x"))
                      for m, c in _measures().items()])
    rows = scored.where(~base_failed()).select(*by, F.inline(cells))
    cutoff = F.greatest(F.length(F.bin("x")) - 6, F.lit(0))
    # shiftleft and shiftright take their distance as a column only in SQL
    return (rows.withColumn("s", cutoff)
            .withColumn("bin", F.expr("shiftleft(shiftright(x, s), s)"))
            .groupBy(*by, "measure", "bin").agg(F.count("*").alias("n")))


def merge(cells: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of a coarser grouping."""
    return cells.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))


def limits(cells: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, size, low_*, high_*)``: quartile fences from each group's sketch."""
    group = Window.partitionBy(*by, "measure")
    ranked = cells.select("*", F.sum("n").over(group).alias("size"),
                          F.sum("n").over(group.orderBy("bin")).alias("upto"))
    quartiles = ranked.groupBy(*by, "measure").agg(
        F.max("size").alias("size"),
        F.min(F.expr("case when 4 * upto >= size then bin end")).alias("q1"),
        F.min(F.expr("case when 4 * upto >= 3 * size then bin end")).alias("q3"))
    reach = REACH * (F.col("q3") - F.col("q1"))
    out = []
    for m, (_, _, _, slack, two_sided) in MEASURES.items():
        own = F.col("measure") == m
        low = F.col("q1") - reach - slack if two_sided else F.lit(-1).cast("long")
        out += [F.max(F.when(own, low)).alias(f"low{m}"),
                F.max(F.when(own, F.col("q3") + reach + slack)).alias(f"high{m}")]
    return quartiles.groupBy(*by).agg(F.max("size").alias("size"), *out)


def adaptive_limits(scored: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``(_q_lang, _q_source, low_*, high_*)`` for every language and source in the table."""
    named = scored.select("*", F.col(f"`{lang}`").alias("_q_lang"),
                          F.col(f"`{source}`").alias("_q_source"))
    cells = cut(sketch(named, ["_q_lang", "_q_source"]), "sketches")
    fine = limits(cells, ["_q_lang", "_q_source"]).alias("a")
    by_lang = limits(merge(cells, ["_q_lang"]), ["_q_lang"]).alias("b")
    names = [f"{side}{m}" for m in MEASURES for side in ("low", "high")]
    overall = limits(merge(cells, []).withColumn("_q_all", F.lit(1)), ["_q_all"])
    joined = fine.join(by_lang, same(F.col("a._q_lang"), F.col("b._q_lang"))).withColumn(
        "c", overall.select(F.struct(*names)).scalar())  # one row, as a value
    return joined.select(
        F.col("a._q_lang"), F.col("a._q_source"),
        *[F.when(F.col("a.size") >= MIN_GROUP, F.col(f"a.{n}"))
          .when(F.col("b.size") >= MIN_GROUP, F.col(f"b.{n}"))
          .otherwise(F.col("c")[n]).alias(n) for n in names])


def judge(scored: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Add ``_q_failed`` (base rules) and ``_q_kept``. ``scored`` should be a written table."""
    table = adaptive_limits(scored, lang, source)
    joined = scored.join(table, same(F.col(f"`{lang}`"), F.col("_q_lang"))
                         & same(F.col(f"`{source}`"), F.col("_q_source")), "left")
    inside = F.lit(True)
    for name, value in _measures().items():
        inside = inside & (value >= F.col(f"low{name}")) & (value <= F.col(f"high{name}"))
    return joined.select(*[F.col(f"`{c}`") for c in scored.columns], base_failed().alias("_q_failed"),
                         (~base_failed() & F.coalesce(inside, F.lit(False))).alias("_q_kept"))


def quality(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source"
            ) -> DataFrame:
    """Scores and verdict of every row; its columns are written once and read from there."""
    return judge(cut(score(df, text), "scored"), lang, source)
