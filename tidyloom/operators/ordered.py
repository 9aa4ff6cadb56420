"""Running sums, row numbers, previous values and forward fill over groups of any size.

A window over a whole group sorts it in one task. Here the window is one over a
group's rows in one range of the order (see ``ranges``), and what a range needs
from those before it - a total, a count, the last values - is added from a table
of at most two rows for each border. There is one plan for all sizes, and no job
runs before the one that asks for the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tidyloom.operators.ranges import POINT, Order, Ranges, renamed_keys, sort_columns


def ordered_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Order],
    *,
    running_sum: Mapping[str, Column] | None = None,
    row_number: str | None = None,
    previous: Mapping[str, Column | tuple[Column, int]] | None = None,
    last_seen: Mapping[str, Column] | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Add columns that depend on the order of rows inside each group.

    ``order`` must be a full order (end it with a unique key), so that the
    answer is the same on every run; ``down`` reverses a column.

    * ``running_sum``: sum of the rows up to and with this one, in the type of a
      plain sum. Doubles are added up in order inside a range, then over ranges; only
      the number of borders, a setting, can change their last digits
    * ``row_number``: 1-based position
    * ``previous``: value in the row before, or with a number the value so many rows before
    * ``last_seen``: latest non-null value up to and with this row

    ``weight`` says how often a row is to count when the order is cut into ranges.
    """
    sums, seen = list((running_sum or {}).items()), list((last_seen or {}).items())
    backs = [(name, value if isinstance(value, tuple) else (value, 1)) for name, value in (previous or {}).items()]
    ranges = Ranges(df, keys, order, weight)
    inputs = {f"_s{i}": value for i, (_, value) in enumerate(sums)}
    inputs |= {f"_p{i}": value for i, (_, (value, _)) in enumerate(backs)} | {f"_l{i}": value for i, (_, value) in enumerate(seen)}
    placed = ranges.place(df.withColumns(inputs) if inputs else df)
    window = Window.partitionBy(*[F.col(f"`{key}`") for key in keys], "_range").orderBy(*sort_columns(order))
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # Inside a range.
    local = {"_n": F.row_number().over(window).cast("long")} if row_number or backs else {}
    local |= {f"_s{i}": F.sum(f"_s{i}").over(so_far) for i in range(len(sums))}
    local |= {f"_p{i}": F.lag(f"_p{i}", back).over(window) for i, (_, (_, back)) in enumerate(backs)}
    local |= {f"_l{i}": F.last(f"_l{i}", ignorenulls=True).over(so_far) for i in range(len(seen))}
    rows = placed.drop(*POINT).withColumns(local)

    # From the ranges before.
    carry = _carried(ranges, placed, window, len(sums), [back for _, (_, back) in backs], len(seen))
    joined = ranges.join_carry(rows, carry, "_range")
    result = {}
    for i, (name, _) in enumerate(sums):
        total, rest = F.col(f"_s{i}"), F.col(f"_s{i}_before")
        # The type of a plain running sum: adding two decimals would widen it.
        result[name] = F.coalesce(total + rest, total, rest).cast(rows.schema[f"_s{i}"].dataType)
    if row_number:
        result[row_number] = F.col("_n") + F.coalesce("_n_before", F.lit(0))
    for i, (name, (_, back)) in enumerate(backs):
        tail = F.col(f"_p{i}_before")
        # Row n of a range looks (back - n + 1) values back into what lies before the range.
        found = F.get(tail, (F.size(tail) - back + F.col("_n") - 1).cast("int"))["v"]
        result[name] = F.when(F.col("_n") <= back, found).otherwise(F.col(f"_p{i}"))
    for i, (name, _) in enumerate(seen):
        result[name] = F.coalesce(f"_l{i}", f"_l{i}_before")
    kept = [F.col(f"`{name}`") for name in df.columns if name not in result]
    return joined.select(*kept, *[column.alias(name) for name, column in result.items()])


def _carried(ranges: Ranges, placed: DataFrame, window, sums: int, backs: list[int], seen: int) -> DataFrame:
    """What lies before each range: counts, sums, last values, for the groups that cross borders."""
    keys = ranges.keys
    crossing = ranges.crossing(placed).drop(*POINT)
    totals = [F.count(F.lit(1)).alias("_n"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(sums)]]
    # Doubles are added in the order of rows, so that a sum is the same however rows lie in tasks.
    inexact = any(isinstance(placed.schema[f"_s{i}"].dataType, (FloatType, DoubleType)) for i in range(sums))
    if backs or seen or inexact:
        # The last rows of a range: as many as the next one looks back. No array is made of other rows.
        most = max([1, *backs])
        whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        local = {"_n": F.row_number().over(window).cast("long"), "_size": F.count(F.lit(1)).over(whole)}
        local |= {f"_s{i}": F.sum(f"_s{i}").over(whole) for i in range(sums)}
        local |= {f"_l{i}": F.last(f"_l{i}", ignorenulls=True).over(whole) for i in range(seen)}
        crossing = crossing.withColumns(local).where(F.col("_size") - F.col("_n") < most)
        totals = [F.max("_size").alias("_n"), *[F.max(f"_s{i}").alias(f"_s{i}") for i in range(sums)]]
        totals += [F.max(f"_l{i}").alias(f"_l{i}") for i in range(seen)]
        totals += [F.sort_array(F.collect_list(F.struct("_n", F.col(f"_p{i}").alias("v")))).alias(f"_p{i}") for i in range(len(backs))]
    ends = crossing.groupBy(*renamed_keys(keys), F.col("_range").alias("_c")).agg(*totals)
    earlier = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_c")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"_{name}_before": F.sum(f"_{name}").over(before) for name in ["n", *[f"s{i}" for i in range(sums)]]}
    carried |= {f"_l{i}_before": F.last(f"_l{i}", ignorenulls=True).over(before) for i in range(seen)}
    for i, back in enumerate(backs):
        # A range has one row at least, so the last ``back`` ranges hold the last ``back`` values.
        tails = F.flatten(F.collect_list(f"_p{i}").over(earlier.rowsBetween(-back, -1)))
        carried[f"_p{i}_before"] = F.slice(tails, F.greatest(F.size(tails) - back + 1, F.lit(1)), F.lit(back))
    return ends.withColumns(carried).select(*[f"_k{i}" for i in range(len(keys))], "_c", *carried)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Order], value: Column, name: str) -> DataFrame:
    return ordered_columns(df, keys, order, running_sum={name: value})


def row_index(df: DataFrame, order: Sequence[Order], name: str, start: int = 1) -> DataFrame:
    """Number the rows of the whole table in order, from ``start`` on."""
    return ordered_columns(df, [], order, row_number=name).withColumn(name, F.col(name) + (start - 1))


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[Order], column: str) -> DataFrame:
    """Fill nulls of a column with the latest value before them."""
    names = df.columns
    return ordered_columns(df, keys, order, last_seen={"_filled": F.col(column)}).select(
        *[F.col("_filled").alias(column) if name == column else F.col(f"`{name}`") for name in names]
    )


def difference_to_previous(df, keys, order, value: Column, name: str) -> DataFrame:
    return ordered_columns(df, keys, order, previous={"_before": value}).withColumn(name, value - F.col("_before")).drop("_before")


def percent_change(df, keys, order, value: Column, name: str, digits: int = 1) -> DataFrame:
    """``100 * (value / previous - 1)``; null in the first row of a group and after a zero."""
    change = F.round(100 * (F.try_divide(value.cast("double"), F.col("_before").cast("double")) - 1), digits)
    return ordered_columns(df, keys, order, previous={"_before": value}).withColumn(name, change).drop("_before")


def rolling_mean(df: DataFrame, keys: Sequence[str], order: Sequence[Order], value: Column, name: str, size: int) -> DataFrame:
    """Mean of this row and the ``size - 1`` before it; null until there are that many.

    The values before are looked up in one pass; of a range only the last
    ``size - 1`` rows are handed on to the next one.
    """
    back = {f"_t{i}": (value, i) for i in range(1, size)}
    frame = ordered_columns(df.withColumn("_t0", value), keys, order, previous=back)
    terms = [F.col(f"_t{i}") for i in range(size)]
    total = sum(terms[1:], terms[0])
    return frame.withColumn(name, total / F.lit(size)).drop(*[f"_t{i}" for i in range(size)])
