"""Reading under a declared schema, and the writers of splits, reports and features."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``, which driver and executors share.

    Without it only a local master gets a temporary folder: elsewhere every executor would
    write to a disk of its own, and a later read would miss rows without an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tallyframe-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header under a declared schema; dirty numbers are declared as text."""
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("escape", '"').csv(path))


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None
               ) -> DataFrame:
    """``.parquet`` is Parquet, anything else CSV; a CSV without schema stays text."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    if schema is not None:
        return read_csv(spark, path, schema)
    return spark.read.option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_splits(df: DataFrame, path: str, column: str = "split") -> None:
    """One CSV folder per part, in one pass over the rows."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .partitionBy(column).csv(path))


def as_document(df: DataFrame, column: str = "document") -> DataFrame:
    """Each row as one JSON document; types JSON lacks become strings."""
    return df.select(F.to_json(F.struct("*")).alias(column))


def from_document(df: DataFrame, schema: T.StructType | str, column: str = "document") -> DataFrame:
    return df.select(F.from_json(column, schema).alias("r")).select("r.*")


def append_report(df: DataFrame, path: str, stamp: str, status: str, run_id: str | None = None) -> None:
    """Append rows stamped with time and overall status, one folder per report date and run.

    A run that is repeated under its id (by default its time stamp) replaces its own folder, so the
    table holds every run once however often a job is started again.
    """
    run_id = stamp if run_id is None else run_id
    (df.withColumns({"timestamp": F.lit(stamp), "overall_status": F.lit(status),
                     "report_date": F.lit(stamp[:10]), "run": F.lit(re.sub(r"[^\w.-]", "-", run_id))})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("report_date", "run").parquet(path))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished write lies at the path; a broken-off one has no marker."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    fs = marker.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.exists(marker)


def cached(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """Read the table at ``path`` when it is complete, else compute and write it."""
    if not is_complete(spark, path):
        write_parquet(compute(), path)
    return spark.read.parquet(path)


def flatten(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """``(path, dotted name)`` of every scalar leaf of a nested schema."""
    out = []
    for f in schema:
        path = f"{prefix}`{f.name}`"
        if isinstance(f.dataType, T.StructType):
            out += flatten(f.dataType, path + ".")
        else:
            out.append((path, path.replace("`", "")))
    return out


def flatten_struct(df: DataFrame) -> DataFrame:
    """Nested records to scalar columns with dotted names."""
    return df.select(*[F.col(path).alias(name) for path, name in flatten(df.schema)])
