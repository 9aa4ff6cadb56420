"""Aggregates by keys, shares of totals, and statistics joined back to detail."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyloom.operators.ranges import renamed_keys, same_keys


def zero_sum(value: Column | str) -> Column:
    """Sum that is 0, not null, for a group of nulls."""
    return F.coalesce(F.sum(value), F.lit(0))


def total_by(df: DataFrame, *keys: str | Column, value: str | Column, name: str = "total_value") -> DataFrame:
    """Sum of a value for any choice of keys."""
    return df.groupBy(*keys).agg(zero_sum(value).alias(name))


def count_by(df: DataFrame, *keys: str | Column, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Add aggregates of each row's group to the row; ``stats`` are plain aggregates.

    The aggregate is taken first (combined on the map side) and joined back, so
    no task has to hold a group, whatever its size; a group of null keys is
    matched too. A few groups are broadcast by Spark itself.
    """
    summed = df.groupBy(*renamed_keys(keys)).agg(*[stat.alias(name) for name, stat in stats.items()])
    if not keys:
        row = summed.select(F.struct(*stats).alias("_row")).scalar()
        return df.withColumns({name: row[name] for name in stats})
    return df.join(summed, same_keys(keys), "left").drop(*[f"_k{i}" for i in range(len(keys))])


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Value over the sum of all rows. The total is a one-value subquery, not a one-task window."""
    total = df.agg(F.sum(value).cast("double").alias("_total")).select("_total").scalar()
    return df.withColumn(name, F.try_divide(F.col(value).cast("double"), total))


def share_of_group(df: DataFrame, keys: Sequence[str], value: str, name: str, *, total: str | None = None) -> DataFrame:
    """Value over the sum of its group."""
    held = total or "_group_total"
    summed = with_group_stats(df, keys, {held: F.sum(value)})
    shared = summed.withColumn(name, F.try_divide(F.col(value).cast("double"), F.col(held).cast("double")))
    return shared if total else shared.drop(held)


def distinct_entity(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row for each key, with its columns; the smallest row stands where several differ."""
    rest = [c for c in columns if c not in key]
    if not rest:
        return df.select(*key).distinct()
    # A minimum over a struct is combined on the map side, unlike a sorted window.
    picked = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def latest_of_group(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``by`` of each group, as a map-side combined aggregate."""
    return _extreme_of_group(df, keys, by, F.max)


def earliest_of_group(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row with the smallest ``by`` of each group."""
    return _extreme_of_group(df, keys, by, F.min)


def _extreme_of_group(df, keys, by, extreme) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in by]
    picked = df.groupBy(*keys).agg(extreme(F.struct(*by, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
