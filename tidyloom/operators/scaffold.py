"""Calendars, key grids, gap filling and ledgers."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyloom.functions.dates import is_weekday
from tidyloom.operators.ordered import ordered_columns, running_sum
from tidyloom.operators.ranges import down
from tidyloom.operators.reshape import melt


def calendar(spark: SparkSession, start: datetime.date, end: datetime.date, name: str = "day") -> DataFrame:
    """One row for each day, ends included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(name))


def working_days(days: DataFrame, day: str, holidays: DataFrame, holiday: str) -> DataFrame:
    """Days that are no weekend and no holiday."""
    closed = holidays.select(F.col(holiday).alias(day))
    return days.join(closed, day, "left_anti").where(is_weekday(day))


def dense_dates(df: DataFrame, date: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Every day between the first and last date, of the table or of each key."""
    edges = df.groupBy(*by).agg(F.min(date).cast("date").alias("_first"), F.max(date).cast("date").alias("_last"))
    return edges.where(F.col("_first").isNotNull()).select(*by, F.explode(F.sequence("_first", "_last")).alias(name))


# Rows of the grid's second side that travel together as one array.
_BLOCK = 1_000


def key_grid(keys: DataFrame, values: DataFrame) -> DataFrame:
    """Every key with every value (agents by months, accounts by days).

    The values are packed in blocks of bounded size, the keys are copied once for
    each block, and the two meet by block number: an equi-join. The number of
    blocks is a value that Spark finds while the query runs. Few blocks are repeated
    for parts of the keys, so that the join is spread where Spark does not
    broadcast it.
    """
    blocks = values.agg(F.greatest(F.ceil(F.count(F.lit(1)) / _BLOCK), F.lit(1)).cast("long").alias("_n")).select("_n").scalar()
    wanted = 4 * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = lambda df: df.withColumns({"_blocks": blocks, "_parts": F.greatest(F.floor(F.lit(wanted) / blocks), F.lit(1))})
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    packed = counted(values).withColumn("_block", F.pmod(F.xxhash64(*values.columns), "_blocks"))
    packed = packed.groupBy("_block", "_parts").agg(F.collect_list(F.struct(*values.columns)).alias("_values"))
    packed = packed.select("_block", "_values", numbers("_parts").alias("_part"))
    copies = counted(keys).withColumn("_part", F.pmod(F.xxhash64(*keys.columns), "_parts")).withColumn("_block", numbers("_blocks"))
    # Rows of the keys are few bytes and many rows of the grid: a number of partitions that is given keeps Spark
    # from putting them in one task, and the hint from broadcasting them to the one task of a small other side.
    spread = copies.repartition(wanted // 4, "_block", "_part")
    joined = spread.join(packed.hint("merge"), ["_block", "_part"])
    return joined.withColumn("_value", F.explode("_values")).select(
        *keys.columns, *[F.col(f"_value.{c}").alias(c) for c in values.columns]
    )


def fill_grid(grid: DataFrame, facts: DataFrame, keys: Sequence[str], defaults: Mapping[str, Any]) -> DataFrame:
    """Left join observed facts to the expected grid and fill the holes."""
    joined = grid.join(facts, list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def runs(df: DataFrame, keys: Sequence[str], day: str, last: Column, until: str = "until") -> DataFrame:
    """Each row as a run of days: from its day to the day before the next one of its key, for the last row up to ``last``.

    A value that holds until it changes takes one row here, however many days it
    holds; days are made of it where they are asked for (``run_days``). ``day`` is distinct within a key.
    """
    following = ordered_columns(df, keys, [down(day)], previous={"_next": F.col(day)})
    return following.withColumn(until, F.coalesce(F.date_sub("_next", 1), last)).drop("_next")


def run_days(df: DataFrame, day: str, until: str = "until", only_on_first: Mapping[str, Any] | None = None) -> DataFrame:
    """One row for each day of each run; a column in ``only_on_first`` keeps its value on the first day and has the given one on the others."""
    only_on_first = only_on_first or {}
    days = df.withColumn("_day", F.explode(F.sequence(day, until)))
    first = F.col("_day") == F.col(day)
    columns = [F.when(first, F.col(c)).otherwise(F.lit(only_on_first[c])).alias(c) if c in only_on_first else F.col("_day").alias(day) if c == day else F.col(f"`{c}`") for c in df.columns if c != until]
    return days.select(*columns)


def signed_flows(transfers: DataFrame, source: str, destination: str, value: Column, name: str = "account") -> DataFrame:
    """Each transfer as two movements: minus at its source, plus at its destination."""
    others = [c for c in transfers.columns if c not in (source, destination)]
    long = melt(transfers, others, [source, destination], names_to="_side", values_to=name)
    sign = F.when(F.col("_side") == destination, F.lit(1)).otherwise(F.lit(-1))
    return long.withColumn("movement", value * sign).drop("_side")


def ledger(opening: DataFrame, movements: DataFrame, account: str, order: Sequence[Column], value: str, name: str = "running_balance") -> DataFrame:
    """Opening balances as first rows, movements after them, and the balance after each row."""
    lines = opening.unionByName(movements, allowMissingColumns=True)
    return running_sum(lines, [account], order, F.col(value), name)
