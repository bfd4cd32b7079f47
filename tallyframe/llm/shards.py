"""A seeded shuffle of all rows into numbered shards, in two passes.

Pass one scatters rows into buckets of about ``bucket_rows`` by a seeded hash; the buckets are
counted and their first positions summed up. Pass two shuffles each bucket by a Fisher-Yates
permutation and writes it. Rows get consecutive positions, so shard ``s`` of ``k`` takes positions
``s * n // k`` up to the next, and shard counts differ by one at most. A bucket lies in one
or two shards, so shards are written from the buckets as they are, without another exchange.
The permutation is drawn over row numbers; rows are never gathered in one cell, and a bucket sorts on
disk if it must.

Keys decide where a row goes; null keys are values like any other. Repeated rows fall into one
bucket with places that can be swapped. An empty table has an empty result. Added columns start
with ``_s``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tallyframe.llm.storage import cut

BUCKET_ROWS = 4_000
RUN = 1_000


def bucket_plan(rows: DataFrame, seed: int) -> DataFrame:
    """``(_s_bucket, _s_base, _s_order)`` from the buckets of the rows."""
    counts = rows.groupBy("_s_bucket").agg(F.count("*").alias("n")).withColumn(
        "run", F.expr(f"_s_bucket div {RUN}"))
    # Sums of runs of buckets first: the window without partitions sees one row per run.
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("run").orderBy("_s_bucket").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.groupBy("run").agg(F.sum("n").alias("of_run")).select(
        "run", F.coalesce(F.sum("of_run").over(before), F.lit(0)).alias("of_earlier"))
    based = counts.join(runs, "run").select("_s_bucket", "n", (
        F.col("of_earlier") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("_s_base"))
    # The generator is seeded by partition; a fixed number of sorted partitions fixes the draws.
    dealt = based.repartition(64, "_s_bucket").sortWithinPartitions("_s_bucket")
    return dealt.select("_s_bucket", "_s_base", F.shuffle(
        F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), F.lit(seed)).alias("_s_order"))


def shard(df: DataFrame, shards: int, keys: list[str], seed: int = 20_240_229,
          bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``_s_shard`` and ``_s_slot`` (0, 1, 2, ... within the shard)."""
    total = df.count()
    buckets = max(1, -(-total // bucket_rows))
    hashed = df.select("*", F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys]).alias("_s_hash"))
    rows = hashed.withColumn("_s_bucket", F.pmod("_s_hash", F.lit(buckets)))
    plan = cut(bucket_plan(rows, seed), "bucket-plan")
    within = Window.partitionBy("_s_bucket").orderBy("_s_hash", *[F.col(f"`{k}`") for k in keys])
    placed = (rows.withColumn("_s_rank", F.row_number().over(within) - 1)
              .join(plan, "_s_bucket")
              .withColumn("_s_at", F.col("_s_base") + F.get("_s_order", F.col("_s_rank"))))
    number = F.expr(f"((_s_at + 1) * {shards} - 1) div {max(total, 1)}")
    return (placed.withColumn("_s_shard", number.cast("int"))
            .withColumn("_s_slot", F.col("_s_at") - F.expr(f"(_s_shard * {total}L) div {shards}"))
            .select(*[F.col(f"`{c}`") for c in df.columns], "_s_shard", "_s_slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, straight from the buckets; rows carry their slot."""
    sharded.write.partitionBy("_s_shard").parquet(path)


def read_shards(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """The rows of written shards with ``_s_shard`` and ``_s_slot``; ``columns`` are those of the table."""
    added = StructType([*columns.fields, StructField("_s_slot", LongType()), StructField("_s_shard", IntegerType())])
    return spark.read.schema(added).parquet(path)
