"""The registered queries: each a Spark job over the given tables and the SQL it must agree with."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    """``items`` are the operators of the blueprint that the query exercises."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    items: str
