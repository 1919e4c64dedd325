"""The registered queries of the operators and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohorta.llm.queries.registry import ORACLES, QUERIES
from cohorta.llm.queries import encoding, filters, search  # noqa: F401  (importing registers the queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
