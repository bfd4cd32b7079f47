"""All registered queries, gathered from the section modules."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

SECTIONS = ["table_queries", "feature_queries", "profile_queries", "score_queries",
            "board_queries", "drift_queries", "monitor_queries", "training_queries"]


def _modules():
    return [import_module(f"tallyframe.plans.{name}") for name in SECTIONS]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for module in _modules():
        out.update(module.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in _modules():
        out.update(module.ORACLES)
    return out
