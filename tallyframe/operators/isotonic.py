"""Isotonic regression from pooled blocks that are merged range by range.

Points are dealt into ranges of scores. Each range pools its own violators into blocks with rising means;
since a block keeps its weight and its mean, pooling the blocks of neighbouring ranges gives what pooling
their points would. So ranges are merged in groups, level by level, until one is left; its blocks are
the knots of the curve. No task sees more than its range or the blocks of a few, and the driver knots only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyframe.sources.tables import scratch_path

#: Ranges that are merged at a time.
FAN = 16
COLUMNS = "part long, low double, high double, weight double, total double"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
Pool = list[list[float]]


def push(stack: Pool, low: float, high: float, weight: float, total: float) -> None:
    """Put a block on a stack of rising means; blocks that would fall are pooled."""
    block = [low, high, weight, total]
    while stack and stack[-1][3] * block[2] >= block[3] * stack[-1][2]:
        first = stack.pop()
        block = [first[0], block[1], first[2] + block[2], first[3] + block[3]]
    stack.append(block)


def _pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each part; rows come by part and in order of scores."""
    part, stack = None, []

    def done() -> pa.RecordBatch:
        return pa.record_batch([pa.array([part] * len(stack), pa.int64()), *(
            pa.array(c, pa.float64()) for c in zip(*stack))], NAMES)

    for batch in batches:
        for number, *block in zip(*(batch.column(c).to_pylist() for c in NAMES)):
            if number != part and stack:
                yield done()
                stack = []
            part = number
            push(stack, *block)
    if stack:
        yield done()


def pooled_blocks(points: DataFrame, fan: int = FAN, ranges: int | None = None) -> DataFrame:
    """``(low, high, weight, value)`` of the fitted steps, in order, from ``points (score, weight, total)``.

    ``points`` have one row per score; ``total`` is the weighted sum of outcomes.
    """
    spark, path = points.sparkSession, scratch_path(points.sparkSession, "isotonic")
    wide = [ranges] if ranges else []
    rows = points.repartitionByRange(*wide, "score").select(
        F.spark_partition_id().cast("long").alias("part"), F.col("score").alias("low"), F.col("score").alias("high"),
        "weight", "total")
    level = 0
    while True:
        rows.sortWithinPartitions("part", "low").mapInArrow(_pooled, COLUMNS).write.parquet(f"{path}/{level}")
        blocks = spark.read.schema(COLUMNS).parquet(f"{path}/{level}")
        if (blocks.agg(F.max("part")).first()[0] or 0) == 0:
            break
        merged = blocks.withColumn("part", F.expr(f"part div {fan}"))
        rows, level = merged.repartition("part"), level + 1
    return blocks.select("low", "high", "weight", (F.col("total") / F.col("weight")).alias("value"))


def knots(points: DataFrame, fan: int = FAN) -> DataFrame:
    """``(score, target, weight)``: both ends of every step; a curve through them is the fit."""
    ends = pooled_blocks(points, fan).select(
        F.explode(F.when(F.col("low") == F.col("high"), F.array("low")).otherwise(F.array("low", "high"))).alias("score"),
        F.col("value").alias("target"),
        F.when(F.col("low") == F.col("high"), F.col("weight")).otherwise(F.col("weight") / 2).alias("weight"))
    return ends.orderBy("score")
