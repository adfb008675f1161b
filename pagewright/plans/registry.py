"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagewright.plans.sql_views import with_views
from pagewright.plans.views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Views`; ``sql`` may name any of the SQL views."""

    def add(function: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Views(spark, folder))
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return function

    return add
