"""Reproducible stratified splits, folds, samples and class weights.

Rows are ordered inside their stratum by md5(key-seed). Only the digest at each cut is
looked up; rows are then labelled by comparing digests, so no row moves and no stratum
is sorted in one task. Keys should be unique: equal keys always land together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.operators.order import ROWS_PER_SORT, settle

#: Digits by which heads of digests grow, and those of a whole digest.
HEAD_DIGITS, DIGEST_DIGITS = 3, 32


def shuffle_digest(key: str | Column, seed: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))


def _cut_digests(df: DataFrame, key: str, stratum: str, shares: Sequence[float], seed: int,
                 rows_per_sort: int) -> DataFrame:
    """``(__stratum, __cut_0, ...)``: digest of the last row of every part but the last.

    The cut rank is the cumulative share of the stratum size, rounded half up; an empty
    part gets "" so that no digest is below it. NULL is a stratum of its own. Each rank is looked
    for among the heads of the digests, then among longer heads inside the one that holds it, until what
    is left fits one sort of different digests; equal digests are counted in the tasks and never ranked.
    """
    rows = df.select(F.col(stratum).alias("stratum"), shuffle_digest(key, seed).alias("digest"))
    ranks, done = [], 0.0
    for share in list(shares)[:-1]:
        done = round(done + share, 12)
        ranks.append(F.expr(f"cast(floor({done!r}D * n + 0.5D) as bigint)"))
    sizes = rows.groupBy("stratum").agg(F.count("*").alias("n"))
    wanted = settle(sizes.select("stratum", F.lit("").alias("head"), F.col("n").alias("within"), F.lit(False).alias("one"),
                                 F.posexplode(F.array(*ranks)).alias("cut", "rank")))
    digits = 0
    while digits < DIGEST_DIGITS:
        largest = wanted.where("not one and rank > 0").agg(F.max("within")).first()[0] or 0
        step = DIGEST_DIGITS if largest <= rows_per_sort else min(digits + HEAD_DIGITS, DIGEST_DIGITS)
        inside = rows.withColumn("of", F.substring("digest", 1, digits))
        if digits:
            held = wanted.select(F.col("stratum").alias("s"), F.col("head").alias("h")).distinct()
            inside = inside.join(held, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("of") == F.col("h")), "left_semi")
        counts = inside.groupBy("stratum", "of", F.substring("digest", 1, step).alias("longer")).agg(
            F.count("*").alias("c"), (F.min("digest") == F.max("digest")).alias("same"))
        upto = F.sum("c").over(Window.partitionBy("stratum", "of").orderBy("longer"))
        counted = counts.select("*", upto.alias("upto"))
        at = wanted.select(F.col("stratum").alias("s"), "head", "cut", "rank")
        wanted = settle(counted.join(at, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("of") == F.col("head"))).where(
            "(rank > upto - c and rank <= upto) or (rank = 0 and upto = c)").select(
            "stratum", F.col("longer").alias("head"), F.col("c").alias("within"), F.col("same").alias("one"), "cut",
            F.when(F.col("rank") > 0, F.col("rank") - F.col("upto") + F.col("c")).otherwise(0).alias("rank")))
        digits = step
    cuts = wanted.groupBy("stratum").agg(*[F.max(F.when((F.col("cut") == i) & (F.col("rank") > 0), F.col("head")))
                                           .alias(f"cut_{i}") for i in range(len(ranks))])
    return settle(cuts.select(F.col("stratum").alias("__stratum"), *[
        F.coalesce(f"cut_{i}", F.lit("")).alias(f"__cut_{i}") for i in range(len(ranks))]))


def stratified_split(df: DataFrame, key: str, stratum: str, parts: dict[str, float],
                     seed: int = 42, column: str = "split",
                     rows_per_sort: int = ROWS_PER_SORT) -> DataFrame:
    """Add ``column``: each stratum is shared out over the named parts.

    Part sizes are within one row of the exact share; the parts are disjoint and
    complete. Shares have to sum to 1.
    """
    if abs(sum(parts.values()) - 1.0) > 1e-6:
        raise ValueError("split fractions must sum to 1.0")
    names = list(parts)
    if len(names) == 1:
        return df.withColumn(column, F.lit(names[0]))
    cuts = _cut_digests(df, key, stratum, list(parts.values()), seed, rows_per_sort)
    digest = shuffle_digest(key, seed)
    label = F.lit(names[-1])
    for i in reversed(range(len(names) - 1)):
        label = F.when(digest <= F.col(f"__cut_{i}"), names[i]).otherwise(label)
    return df.join(cuts, F.col(stratum).eqNullSafe(F.col("__stratum"))).select(
        *[F.col(c) for c in df.columns], label.alias(column))


def stratified_folds(df: DataFrame, key: str, stratum: str, k: int = 3, seed: int = 42,
                     column: str = "fold", rows_per_sort: int = ROWS_PER_SORT) -> DataFrame:
    """Add a fold number 0..k-1; folds of a stratum differ by at most one row."""
    parts = {str(i): 1.0 / k for i in range(k)}
    out = stratified_split(df, key, stratum, parts, seed, column, rows_per_sort)
    return out.withColumn(column, F.col(column).cast("int"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The n rows with the smallest digests; every task keeps its n best."""
    return df.orderBy(shuffle_digest(key, seed), key).limit(n)


def head_sample(df: DataFrame, key: str, n: int = 200) -> DataFrame:
    return df.orderBy(key).limit(n)


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """``(class, n, pct)`` with 2 decimals; the share is of all rows."""
    counts = settle(df.groupBy(F.col(column).cast("string").alias("class"))
                    .agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n"))
    return counts.select("class", "n", F.round(
        F.col("n") * 100.0 / total.scalar(), 2).alias("pct"))


def class_weights(df: DataFrame, column: str) -> DataFrame:
    """``(class, n, weight)`` with weight = rows / (classes * rows of the class)."""
    counts = settle(df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("class"))
                    .agg(F.count("*").alias("n")))
    whole = counts.agg((F.sum("n") / F.count("*")).alias("mean_n"))
    return counts.select("class", "n", (whole.scalar() / F.col("n")).alias("weight"))


def with_class_weights(df: DataFrame, column: str, weight: str = "weight") -> DataFrame:
    w = class_weights(df, column).select(F.col("class").alias("__class"),
                                         F.col("weight").alias(weight))
    return df.join(w, F.col(column) == F.col("__class"), "left").drop("__class")
