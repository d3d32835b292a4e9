"""The registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import clouds, files, reports, routes, stored, views, work  # noqa: F401  they register themselves
from .registry import QUERIES, SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["scene_describe_length"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
