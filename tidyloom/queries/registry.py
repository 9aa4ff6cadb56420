"""Where queries and their SQL twins are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def moment(text: str) -> Column:
    """A timestamp literal without zone, so that comparisons reach the Parquet scan."""
    return F.lit(text).cast("timestamp_ntz")


def in_year(column: str, year: int) -> Column:
    """A range on the stored timestamp; ``year(column) = ...`` could not be pushed down."""
    return (F.col(column) >= moment(f"{year}-01-01")) & (F.col(column) < moment(f"{year + 1}-01-01"))
