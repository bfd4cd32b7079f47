"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Temporary folders of local applications that have no setting, by application.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only for a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "")
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="llm-")
    return _LOCAL[app]


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and go on from the files: no lineage, no second computation."""
    path = shared_path(df.sparkSession, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
