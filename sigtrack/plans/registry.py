"""The registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import source_queries, support_queries  # noqa: F401  they register their queries
from .queries import QUERIES, SQL
from .views import Tables


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))) for name, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
