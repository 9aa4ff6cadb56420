"""Ranges of an order, so that a group of any size is worked on in pieces.

Borders are points of the order (keys, then order columns), drawn by a hash of
each point: the same rows give the same borders whenever and wherever they are
read again, so nothing has to be counted, stored or run before the job itself.
There are some borders for each shuffle partition, drawn from all groups: a large
group gets many, and most small ones get none and stay one range. A row finds its
range by binary search among its group's borders.

What a range needs from those before it is a table of at most two rows for each
border, which is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyloom.settings import borders_of


@dataclass(frozen=True)
class Down:
    """A column of an order whose largest values come first; nulls are the smallest values."""

    column: Column


Order = Column | Down

#: What ``Ranges.place`` adds beside the range; not to be shuffled.
POINT = ("_borders", "_point")


def down(column: Column | str) -> Down:
    return Down(F.col(column) if isinstance(column, str) else column)


def sort_columns(order: Sequence[Order]) -> list[Column]:
    """The order for ``orderBy`` and windows."""
    return [o.column.desc() if isinstance(o, Down) else o.asc() for o in order]


def same_keys(keys: Sequence[str], prefix: str = "_k") -> Column:
    """Equality on keys against columns ``_k0, _k1, ...`` that also matches null to null."""
    tests = [F.col(f"`{key}`").eqNullSafe(F.col(f"{prefix}{i}")) for i, key in enumerate(keys)]
    return reduce(lambda a, b: a & b, tests)


def renamed_keys(keys: Sequence[str], prefix: str = "_k") -> list[Column]:
    return [F.col(f"`{key}`").alias(f"{prefix}{i}") for i, key in enumerate(keys)]


def _comparable(o: Order, kind: T.DataType) -> list[Column] | None:
    """Columns whose rising order is that of ``o``; None where only a comparison by hand gives it."""
    if not isinstance(o, Down):
        return [o]
    column = o.column
    if isinstance(kind, T.DateType):
        column, kind = F.unix_date(column), T.IntegerType()
    if isinstance(kind, T.IntegralType):
        return [column.isNull(), F.bitwise_not(column)]
    if isinstance(kind, T.DecimalType):
        return [column.isNull(), -column]
    if isinstance(kind, T.FractionalType):
        return [column.isNull(), ~F.isnan(column), -column]
    return None


class Ranges:
    """Ranges of the rows of each group of one frame.

    ``points`` gives the points from which borders are drawn, by weight where
    there is one. ``place`` adds ``_range``, the number of the group's borders up to
    the row and with it; ``crossing`` keeps the rows of groups that have a border.
    """

    def __init__(self, points: DataFrame, keys: Sequence[str], order: Sequence[Order], weight: Column | None = None):
        self.keys = list(keys)
        self.most = borders_of(points.sparkSession)
        plain = points.select(*[(o.column if isinstance(o, Down) else o).alias(f"o{i}") for i, o in enumerate(order)])
        parts = [_comparable(o, field.dataType) for o, field in zip(order, plain.schema)]
        #: Which columns of a point fall; None where all of them rise, so that Spark can compare points as a whole.
        self.falls = None if all(parts) else [isinstance(o, Down) for o in order]
        self.columns = [c for part in parts for c in part] if self.falls is None else [o.column if isinstance(o, Down) else o for o in order]
        drawn = points.select(*self._names(), self._point().alias("_point"), (F.lit(1) if weight is None else weight).cast("double").alias("_weight"))
        # The smallest of -ln(u) / weight, with u from the hash: a point is drawn about as often as its weight asks.
        u = (F.pmod(F.xxhash64(*self._names(by_place=True), "_point"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        drawn = drawn.withColumn("_turn", -F.log(u) / F.col("_weight")).drop("_weight")
        drawn = drawn.orderBy("_turn", *self._names(by_place=True), "_point").limit(self.most)
        found = F.array_distinct(F.collect_list("_point"))
        sorted_ = F.array_sort(found) if self.falls is None else F.array_sort(found, self._compare)
        listed = drawn.groupBy(*self._names(by_place=True)).agg(sorted_.alias("_borders"))
        self.borders = listed if keys else listed.select("_borders").scalar()

    def _names(self, by_place: bool = False) -> list[Column]:
        return [F.col(f"_b{i}") if by_place else F.col(f"`{key}`").alias(f"_b{i}") for i, key in enumerate(self.keys)]

    def _point(self) -> Column:
        return F.struct(*[column.alias(f"p{i}") for i, column in enumerate(self.columns)])

    def _after(self, a: Column, b: Column) -> Column:
        """Whether point ``a`` comes after point ``b``; null is smaller than any value."""
        if self.falls is None:
            return a > b
        test = F.lit(False)
        for i in reversed(range(len(self.falls))):
            x, y = (b[f"p{i}"], a[f"p{i}"]) if self.falls[i] else (a[f"p{i}"], b[f"p{i}"])
            larger = x.isNotNull() & (y.isNull() | (x > y))
            test = F.coalesce(larger, F.lit(False)) | (x.eqNullSafe(y) & test)
        return test

    def _compare(self, a: Column, b: Column) -> Column:
        return F.when(self._after(a, b), 1).when(self._after(b, a), -1).otherwise(0)

    def place(self, df: DataFrame) -> DataFrame:
        """Add ``_range`` and the columns of ``POINT``."""
        if self.keys:
            # At most as many rows as there are borders.
            placed = df.join(F.broadcast(self.borders), same_keys(self.keys, "_b"), "left").drop(*[f"_b{i}" for i in range(len(self.keys))])
        else:
            placed = df.withColumn("_borders", self.borders)
        placed = placed.withColumn("_point", self._point())
        # A search written as one higher-order function would end Spark's generated code, which copies the borders into
        # every row; as one column after the other no row is made between the steps. Null borders are never behind.
        placed = placed.withColumn("_range", F.lit(0))
        at, borders, point = F.col("_range"), F.col("_borders"), F.col("_point")
        for step in [1 << i for i in reversed(range(self.most.bit_length()))]:
            reached = F.get(borders, at + (step - 1))
            behind = ~self._after(reached, point) if self.falls is None else reached.isNotNull() & ~self._after(reached, point)
            placed = placed.withColumn("_range", F.when(behind, at + step).otherwise(at))
        # A step names the one before it several times. Spark's optimizer follows a join key or a condition down to the
        # table and writes each step out there, which triples the expression every time; what explode gives has no such origin.
        return placed.withColumn("_range", F.explode(F.array("_range")))

    def at_border(self) -> Column:
        """Whether a placed row's point is a border."""
        return (F.col("_range") > 0) & F.coalesce(F.get("_borders", F.col("_range") - 1).eqNullSafe(F.col("_point")), F.lit(False))

    def crossing(self, placed: DataFrame) -> DataFrame:
        return placed.where(F.col("_borders").isNotNull()) if self.keys else placed

    def join_carry(self, placed: DataFrame, carry: DataFrame, place: str) -> DataFrame:
        """Add the columns of ``carry`` (keys ``_k0`` ..., ``_c``) to rows by key and number.

        There are at most two ranges for each border, so the table is broadcast.
        """
        same = F.col(place) == F.col("_c")
        joined = placed.join(F.broadcast(carry), same_keys(self.keys) & same if self.keys else same, "left")
        return joined.drop(*[f"_k{i}" for i in range(len(self.keys))], "_c")
