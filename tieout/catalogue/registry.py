"""Every query by name, with the SQL that states the same result independently."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        @wraps(function)
        def in_utc(spark: SparkSession, folder: str) -> DataFrame:
            # Instants are UTC; the session's zone is part of what a timestamp means.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, folder)

        QUERIES[name] = in_utc
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def shown(*columns: str):
    """Timestamps as text, so that both engines print them alike."""
    return {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns}


def sql_shown(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
