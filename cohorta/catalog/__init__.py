"""The registered queries and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohorta.catalog.registry import ORACLES, QUERIES
from cohorta.catalog import (  # noqa: F401  (importing registers the queries)
    cleaning, evaluation, exploration, jobs, modelling, profiling, relational, sampling,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
