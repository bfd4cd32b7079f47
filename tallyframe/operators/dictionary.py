"""Dense codes for the values of text columns, however many there are.

Different values are dealt into ranges in order; the ranges are counted, and a value's code is the
number of values in earlier ranges plus its place in its own. The codes are a written table that is
joined to rows: no list of values is held on the driver or in one cell. Catalyst broadcasts a small
dictionary by its size and shuffles a large one, where adaptive execution splits frequent values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyframe.sources.tables import scratch_path


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value)``: the different non-null values of each column."""
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return (texts.unpivot([], list(columns), "feature", "value").where(F.col("value").isNotNull()).distinct())


@dataclass(frozen=True)
class Dictionary:
    """A table ``(feature, value, code)`` at ``path``; ``sizes`` has the number of codes per column."""

    path: str
    sizes: dict[str, int]

    @classmethod
    def fit(cls, train: DataFrame, columns: Sequence[str], path: str | None = None) -> Dictionary:
        """Codes from 0 in the order of the values' bytes."""
        spark = train.sparkSession
        path = path or scratch_path(spark, "dictionary")
        values = distinct_values(train, columns)
        values.repartitionByRange("feature", "value").withColumn("part", F.spark_partition_id()).write.mode(
            "overwrite").parquet(f"{path}-ranges")
        dealt = spark.read.parquet(f"{path}-ranges")
        counts = dealt.groupBy("feature", "part").agg(F.count("*").alias("n"))  # a row per range
        before = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select("feature", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
        place = F.row_number().over(Window.partitionBy("feature", "part").orderBy("value")) - 1
        dealt.withColumn("place", place).join(starts, ["feature", "part"]).select(
            "feature", "value", (F.col("start") + F.col("place")).cast("int").alias("code")).write.mode("overwrite").parquet(path)
        sizes = {r["feature"]: r["n"] for r in counts.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
        return cls(path, {c: sizes.get(c, 0) for c in columns})

    def codes(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("feature string, value string, code int").parquet(self.path)

    def copied(self, spark: SparkSession, path: str) -> Dictionary:
        """The same dictionary at another path."""
        self.codes(spark).write.mode("overwrite").parquet(path)
        return Dictionary(path, self.sizes)

    def encode(self, df: DataFrame) -> DataFrame:
        """Add ``<column>_code``: null for null and for values the training rows never held."""
        for c in self.sizes:
            own = self.codes(df.sparkSession).where(F.col("feature") == c).select(
                F.col("value").alias("__value"), F.col("code").alias(f"{c}_code"))
            df = df.join(own, F.col(f"`{c}`").cast("string") == F.col("__value"), "left").drop("__value")
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``<column>_vector``, one-hot and sparse; null and unseen values are zero everywhere."""
        names, out = df.columns, self.encode(df)
        for c, size in self.sizes.items():
            # The size is written to the column, so that the encoder looks at no row; the last place is left out.
            meta = {"ml_attr": {"type": "nominal", "name": f"{c}_code", "num_vals": size + 1}}
            code = F.coalesce(F.col(f"`{c}_code`"), F.lit(size)).cast("double")
            out = out.withColumn(f"{c}_code", code.alias(f"{c}_code", metadata=meta))
        sized = [c for c, n in self.sizes.items() if n]
        if sized:
            out = OneHotEncoder(inputCols=[f"{c}_code" for c in sized], outputCols=[f"{c}_vector" for c in sized]
                                ).fit(out.limit(0)).transform(out)
        return out.select(*[F.col(f"`{n}`") for n in names], *[F.col(f"`{c}_vector`") for c in sized])
