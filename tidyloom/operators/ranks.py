"""Ranks, best-of-group filters and quantile bins."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyloom.operators.ordered import ordered_columns
from tidyloom.operators.ranges import POINT, Order, Ranges, down, renamed_keys, same_keys


def _direction(column: str, descending: bool) -> Column:
    return F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()


def ranked(df: DataFrame, keys: Sequence[str], value: str, name: str = "rank", *, ties: str = "min", descending: bool = False) -> DataFrame:
    """Rank a value inside its group; ties take the lowest (``min``) or highest (``max``) rank.

    A null value gets a null rank. A rank is the number of rows before the row's
    range and its rank inside it. Borders are drawn from the counted values, so
    a frequent value is a border; the rows that have it, and rows without a
    value, need no order and stay spread over tasks.
    """
    if ties not in ("min", "max"):
        raise ValueError("ties must be 'min' or 'max'; use ordinal_rank for a rank without ties")
    column = F.col(f"`{value}`")
    known = df.where(column.isNotNull()).select(*[F.col(f"`{key}`") for key in dict.fromkeys([*keys, value])])
    counts = known.groupBy(*known.columns).agg(F.count(F.lit(1)).alias("_same"))
    ranges = Ranges(counts, keys, [down(column) if descending else column], F.col("_same"))
    # Even: between two borders; odd: at a border; -1: no value.
    step = F.when(column.isNull(), -1).when(ranges.at_border(), 2 * F.col("_range") - 1).otherwise(2 * F.col("_range"))
    rows = ranges.place(df).withColumn("_step", step).drop("_range", *POINT)
    rows = rows.withColumn("_spread", F.when(F.abs(F.col("_step")) % 2 == 1, F.spark_partition_id()).otherwise(0))
    window = Window.partitionBy(*[F.col(f"`{key}`") for key in keys], "_step", "_spread").orderBy(_direction(value, descending))
    # The default frame of an ordered window takes all ties of a row with it.
    rows = rows.withColumn("_local", F.rank().over(window) if ties == "min" else F.count(column).over(window))
    crossing = ranges.crossing(ranges.place(counts)).withColumn("_step", step)
    steps = crossing.groupBy(*renamed_keys(keys), F.col("_step").alias("_c")).agg(F.sum("_same").alias("_here"))
    before = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    carry = steps.withColumn("_before", F.coalesce(F.sum("_here").over(before), F.lit(0)))
    joined = ranges.join_carry(rows, carry, "_step")
    tied = F.lit(1) if ties == "min" else F.col("_here")
    rank = F.coalesce("_before", F.lit(0)) + F.when(F.col("_step") % 2 == 1, tied).otherwise(F.col("_local"))
    ranked_rows = joined.withColumn(name, F.when(column.isNotNull(), rank.cast("long")))
    return ranked_rows.drop("_step", "_spread", "_local", "_here", "_before")


def ordinal_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Order], name: str = "rank") -> DataFrame:
    """Positions 1, 2, 3 ... without ties; ``order`` must be a full order."""
    return ordered_columns(df, keys, order, row_number=name)


def best_of_group(df: DataFrame, keys: Sequence[str], value: str, n: int, name: str = "rank", *, descending: bool = False) -> DataFrame:
    """Rows ranked ``n`` or better in their group, ties kept.

    The rank is given to the best ``n`` distinct values and joined back: very
    many ties for a rank are counted on the map side and never meet in one
    task. Of other values a split sends its best ``n`` for each group.
    """
    known = df.where(F.col(value).isNotNull())
    order = F.col(value).desc() if descending else F.col(value).asc()
    counts = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_same"))
    # At most n values of a group are left before its counts are summed up.
    top = first_of_group(counts, keys, [order], n)
    upto = F.sum("_same").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    ranks = top.withColumn(name, F.coalesce(upto, F.lit(0)) + 1).where(F.col(name) <= n)
    wanted = ranks.select(*renamed_keys([*keys, value]), name)
    return known.join(wanted, same_keys([*keys, value])).drop(*[f"_k{i}" for i in range(len(keys) + 1)])


def first_of_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in a full order, trimmed before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_position", F.row_number().over(window)).where(F.col("_position") <= n).drop("_position")


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    name: str = "quantiles",
    stats: Mapping[str, Callable[[Column, Column], Column]] | None = None,
) -> DataFrame:
    """Exact quantiles, linear between neighbours, as one array for each group.

    Values are counted, the counts summed up in order by ranges, and the values
    at the wanted positions picked by conditional minimum: no task holds a
    group's values. ``stats`` adds aggregates, each made from the value and how
    often it occurs in the group, so that one read of the source serves all; with
    them a group without a value stays, with nulls.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_x"))
    counts = (rows if stats else rows.where(F.col("_x").isNotNull())).groupBy(*keys, "_x").agg(F.count("_x").alias("_same"))
    # The running count of a value's last row, and the size of its group.
    # The weight is 1, yet made from the count: so the borders come from the same shuffle as the rest.
    running = ordered_columns(counts, keys, [F.col("_x")], running_sum={"_upto": F.col("_same")}, weight=F.when(F.col("_same") >= 0, 1))
    sizes = counts.groupBy(*renamed_keys(keys)).agg(F.sum("_same").alias("_size"))
    if keys:
        sized = running.join(sizes, same_keys(keys))
    else:
        sized = running.withColumn("_size", sizes.select("_size").scalar())
    picks = [make(F.col("_x"), F.col("_same")).alias(stat) for stat, make in (stats or {}).items()]
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("_size") - 1)
        picks += [
            F.min(F.when(F.col("_upto") > F.floor(position), F.col("_x"))).alias(f"_lo{i}"),
            F.min(F.when(F.col("_upto") > F.ceil(position), F.col("_x"))).alias(f"_hi{i}"),
            F.max(F.ceil(position) - position).alias(f"_u{i}"),
            F.max(position - F.floor(position)).alias(f"_w{i}"),
        ]
    # The arithmetic of ``percentile``.
    lo, hi = (lambda i: F.col(f"_lo{i}")), (lambda i: F.col(f"_hi{i}"))
    between = [F.when(lo(i) == hi(i), lo(i)).otherwise(F.col(f"_u{i}") * lo(i) + F.col(f"_w{i}") * hi(i)) for i in range(len(probabilities))]
    return sized.groupBy(*keys).agg(*picks).select(*keys, F.array(*between).alias(name), *(stats or {}))


def quantile_bins(
    df: DataFrame, keys: Sequence[str], value: str, bins: int | Sequence[float], labels: Sequence[str], name: str
) -> DataFrame:
    """Label each value by the quantile interval of its group that holds it: ``(low, high]``.

    ``bins`` is a number of equal bins, or the inner probabilities. Where two
    breaks fall on one value the bin between them stays empty.
    """
    inner = [i / bins for i in range(1, bins)] if isinstance(bins, int) else list(bins)
    if len(labels) != len(inner) + 1:
        raise ValueError(f"{len(inner) + 1} labels are needed, not {len(labels)}")
    if any(not 0 < p < 1 or math.isnan(p) for p in inner):
        raise ValueError("inner probabilities lie between 0 and 1")
    breaks = group_quantiles(df, keys, value, inner, "_breaks").select(*renamed_keys(keys), "_breaks")
    if keys:
        joined = df.join(breaks, same_keys(keys), "left").drop(*[f"_k{i}" for i in range(len(keys))])
    else:
        joined = df.withColumn("_breaks", breaks.select("_breaks").scalar())
    label = None
    for i, text in enumerate(labels[:-1]):
        test = F.col(value) <= F.col("_breaks")[i]
        label = F.when(test, F.lit(text)) if label is None else label.when(test, F.lit(text))
    label = label.when(F.col(value).isNotNull(), F.lit(labels[-1]))
    return joined.withColumn(name, label).drop("_breaks")
