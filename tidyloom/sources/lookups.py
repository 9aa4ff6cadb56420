"""Small lookup tables written in code, and joins to them."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def inline_table(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def lookup(df: DataFrame, table: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join to an inline table. It is in the code, so its size is known and it is sent to every task."""
    return df.join(F.broadcast(table), on, how)
