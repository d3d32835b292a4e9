"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import session
from .proxies import Proxies

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(text: str | None = None) -> Callable:
    """Register a function of Proxies under its name, with the SQL of the same result."""

    def register(f: Callable[[Proxies], DataFrame]) -> Callable[[Proxies], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.ship(spark)
            return f(Proxies(spark, sf_dir))

        QUERIES[f.__name__] = run
        if text:
            SQL[f.__name__] = text
        return f

    return register
