"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is a number of words. Each of its documents should be taken ``target / size``
times, a whole number plus a fraction. The fractions are rounded together: two documents meet,
and words move from one to the other until one of them holds none or all of its size. The direction
is drawn so that each document keeps its expected share, and the sum never changes. Documents are
dealt into groups of about ``GROUP`` by a seeded hash within their source; a group
leaves one unsettled document, and these meet again on the next level, until a source has
one left, which is drawn by itself. So a source misses its target by less than one document, and the
levels of this tree are a few shuffles of a table that shrinks by ``GROUP`` each time.

Null texts have size 0 and are never taken by weight of words (their copies are the whole part
of the ratio); a null source is a source, ranked last; repeated rows are settled one by one; an
empty table has an empty result. Draws depend on the seed and the rows only, so reruns agree.
Added columns start with ``_m``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tallyframe.llm.columns import same, words
from tallyframe.llm.storage import cut

GROUP = 48
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2


def source_targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from rows of ``(source, size)``.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of
    all sizes; a target stops at ``most`` times its source and the rest goes to the others by
    weight. With the sources ordered by the level at which they fill up, the level of
    the first one that the remaining words cannot fill is the common level of all that follow.
    Both windows run over one row per source.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sums.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn).cast("long"))
    full = F.col("source_size") * most
    filling = Window.orderBy(full / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0)
    left = share * F.sum("source_size").over(every) - F.coalesce(F.sum(full).over(before), zero)
    heavy = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), zero)
    ranked = weighed.select("*", full.cast("double").alias("full"), (left / heavy).alias("level"),
                            F.row_number().over(filling).alias("n"))
    first = F.min_by("level", F.when(F.col("level") * F.col("weight") <= F.col("full"), F.col("n")))
    return ranked.withColumn("water", first.over(every)).select(
        "source", "source_size", F.least(F.col("water") * F.col("weight"), "full").alias("target"))


ITEM = "struct<h: bigint, id: bigint, tie: bigint, occ: int, size: bigint, whole: bigint, mass: double>"
DONE = "struct<id: bigint, tie: bigint, occ: int, size: bigint, copies: bigint>"


def _pivot(seed: int, level: int) -> str:
    """SQL of one meeting: ``acc.cur`` and ``x``; one is settled, the other goes on."""
    a, b = "acc.cur", "x"
    room_a, room_b = f"({a}.size - {a}.mass)", f"({b}.size - {b}.mass)"
    to_a, to_b = f"least({room_a}, {b}.mass)", f"least({a}.mass, {room_b})"
    draw = f"(shiftrightunsigned(xxhash64({seed}L, {level}, {a}.h, {b}.h), 11) / 9007199254740992D)"

    def settled(one: str, up: str) -> str:
        return (f"named_struct('id', {one}.id, 'tie', {one}.tie, 'occ', {one}.occ, "
                f"'size', {one}.size, 'copies', {one}.whole + {up})")

    def going(one: str, mass: str) -> str:
        return (f"named_struct('h', {one}.h, 'id', {one}.id, 'tie', {one}.tie, 'occ', {one}.occ, "
                f"'size', {one}.size, 'whole', {one}.whole, 'mass', {mass})")

    def result(cur: str, done: str) -> str:
        return f"named_struct('cur', {cur}, 'out', concat(acc.out, array({done})))"

    return f"""
case when acc.cur is null then named_struct('cur', x, 'out', acc.out)
  when {draw} * ({to_a} + {to_b}) < {to_b} then
    case when {room_a} <= {b}.mass then {result(going(b, f"{b}.mass - {room_a}"), settled(a, '1'))}
      else {result(going(a, f"{a}.mass + {b}.mass"), settled(b, '0'))} end
  else
    case when {a}.mass <= {room_b} then {result(going(b, f"{b}.mass + {a}.mass"), settled(a, '0'))}
      else {result(going(a, f"{a}.mass - {room_b}"), settled(b, '1'))} end
end"""


def _level(items: DataFrame, seed: int, level: int) -> DataFrame:
    """One level of the tree: per group the settled documents and at most one that goes on.

    ``items``: source and one struct ``item``. Groups of a source number ``n / GROUP``.
    """
    sizes = items.groupBy(F.col("source").alias("of")).agg(F.count("*").alias("n"))
    hashed = F.xxhash64(F.lit(seed), F.lit(level), "item.h")
    grouped = (items.join(sizes, same(F.col("source"), F.col("of")))
               .select("source", F.expr("n <= 1.5 * " + str(GROUP)).alias("last"),
                       F.pmod(hashed, F.expr(f"greatest(1, n div {GROUP})")).alias("g"), "item")
               .groupBy("source", "last", "g").agg(F.sort_array(F.collect_list("item")).alias("items")))
    folded = F.expr(f"""aggregate(items,
        named_struct('cur', cast(null as {ITEM}), 'out', cast(array() as array<{DONE}>)),
        (acc, x) -> {_pivot(seed, level)})""")
    rest = (f"shiftrightunsigned(xxhash64({seed}L, -1, f.cur.h), 11) / 9007199254740992D "
            "* f.cur.size < f.cur.mass")
    lonely = f"""named_struct('id', f.cur.id, 'tie', f.cur.tie, 'occ', f.cur.occ, 'size', f.cur.size,
        'copies', f.cur.whole + case when {rest} then 1 else 0 end)"""
    return (grouped.select("source", "last", F.inline(F.array(F.struct(folded.alias("f")))))
            .select("source", F.expr("case when not last then f.cur end").alias("item"),
                    F.expr(f"case when last then concat(f.out, array({lonely})) else f.out end")
                    .alias("done")))


def copies(rows: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """``(source, id, tie, occ, size, copies)`` for rows of ``(id, tie, source, size)``.

    ``occ`` numbers rows that are alike.
    """
    alike = rows.groupBy("id", "tie", "source", "size").agg(F.count("*").cast("int").alias("n"))
    single = alike.withColumn("occ", F.explode(F.expr("sequence(1, n)"))).drop("n")
    targets = targets.withColumnRenamed("source", "of")
    ratio = F.coalesce(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size")), F.lit(0.0))
    asked = (single.join(targets, same(F.col("source"), F.col("of")))
             .withColumn("whole", F.floor(ratio))
             .withColumn("mass", F.col("size") * (ratio - F.col("whole"))))
    asked = cut(asked.select(
        "source", "id", "tie", "occ", "size", "whole", "mass",
        F.xxhash64(F.lit(seed), "id", "tie", "occ").alias("h")), "asked")
    open_ = F.col("mass") > 0
    settled = [asked.where(~open_).select("source", "id", "tie", "occ", "size",
                                          F.col("whole").alias("copies"))]
    items = asked.where(open_).select("source", F.struct(
        "h", "id", "tie", "occ", "size", "whole", "mass").alias("item"))
    level = 0
    while True:
        step = cut(_level(items, seed, level), f"level-{level}")
        settled.append(step.select("source", F.inline("done")))
        items = step.where("item is not null").select("source", "item")
        level += 1
        if items.isEmpty():
            break
    return reduce(DataFrame.unionByName, settled)


def sized(df: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text"
          ) -> DataFrame:
    """The narrow table ``(id, tie, source, size)``; ``tie`` is a digest of the text."""
    return cut(df.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                         F.xxhash64(F.col(f"`{text}`")).alias("tie"),
                         F.col(f"`{source}`").cast("string").alias("source"),
                         F.size(words(F.col(f"`{text}`"))).cast("long").alias("size")), "sizes")


def mix(df: DataFrame, seed: int = 7, id_column: str = "doc_id", source: str = "source",
        text: str = "text") -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it."""
    rows = sized(df, id_column, source, text)
    taken = cut(copies(rows, source_targets(rows), seed), "copies").withColumnRenamed("copies", "_m_copies")
    keyed = df.select("*", F.col(f"`{id_column}`").cast("long").alias("_m_id"),
                      F.xxhash64(F.col(f"`{text}`")).alias("_m_tie"),
                      F.col(f"`{source}`").cast("string").alias("_m_source"))
    key = ["_m_id", "_m_tie", "_m_source"]
    renamed = taken.select(F.col("id").alias("_t_id"), F.col("tie").alias("_t_tie"),
                           F.col("source").alias("_t_source"), F.col("occ").alias("_t_occ"), "_m_copies")
    match = (same(F.col("_m_id"), F.col("_t_id")) & (F.col("_m_tie") == F.col("_t_tie"))
             & same(F.col("_m_source"), F.col("_t_source")))
    if not renamed.where("_t_occ > 1").isEmpty():
        numbered = Window.partitionBy(*key).orderBy(*key)
        keyed = keyed.withColumn("_m_occ", F.row_number().over(numbered))
        match = match & (F.col("_m_occ") == F.col("_t_occ"))
    joined = keyed.join(renamed.where("_m_copies > 0"), match)
    return (joined.withColumn("_m_copy", F.explode(F.expr("sequence(1, cast(_m_copies as int))")))
            .select(*[F.col(f"`{c}`") for c in df.columns]))
