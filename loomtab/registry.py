"""The queries of the tabular operators, and SQL for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .queries import base, files, groups, quality, shapes, workflow  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.ORACLES)
