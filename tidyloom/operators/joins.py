"""Lookups, role joins, band joins, next-date joins and id fill-in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyloom.operators.ordered import ordered_columns
from tidyloom.operators.ranges import down

def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rename columns for one role of a table that is joined more than once."""
    return df.select(*[F.col(f"`{c}`").alias(c if c in keep else f"{prefix}{c}") for c in df.columns])


def role_join(df: DataFrame, dimension: DataFrame, key: str, roles: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join one dimension several times: ``roles`` maps a column of ``df`` to a name prefix."""
    for column, prefix in roles.items():
        role = prefixed(dimension, prefix)
        df = df.join(role, F.col(column) == F.col(prefix + key), how).drop(prefix + key)
    return df


def left_lookup(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join on a key that may often be null.

    Null never matches, yet a shuffle would send all null rows to one task. A
    second key, always 0 in the lookup, spreads them instead.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != key]
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*others), F.lit(997)) if others else F.lit(0)).otherwise(F.lit(0))
    left = df.withColumn("_spread", spread.cast("long"))
    right = lookup.where(F.col(key).isNotNull()).withColumn("_spread", F.lit(0).cast("long"))
    return left.join(right, [key, "_spread"], "left").drop("_spread")


def id_pairs(frames: Sequence[DataFrame], first: str, second: str) -> DataFrame:
    """Distinct pairs of two ids that are seen together in any of the frames."""
    pairs = frames[0].select(first, second)
    for frame in frames[1:]:
        pairs = pairs.unionByName(frame.select(first, second))
    return pairs.dropna().distinct()


def fill_ids(df: DataFrame, pairs: DataFrame, first: str, second: str) -> DataFrame:
    """Fill either of two ids from the other by a table of known pairs."""
    names = df.columns
    by_first = pairs.select(F.col(first), F.col(second).alias("_second"))
    by_second = pairs.select(F.col(second), F.col(first).alias("_first"))
    joined = left_lookup(left_lookup(df, by_first, first), by_second, second)
    filled = {first: F.coalesce(first, "_first"), second: F.coalesce(second, "_second")}
    return joined.select(*[filled[n].alias(n) if n in filled else F.col(f"`{n}`") for n in names])


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a partner; rows with a null key stay."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def band_join(df: DataFrame, bands: DataFrame, value: Column, low: str, high: str) -> DataFrame:
    """Join rows to the bands that hold a value, both ends included.

    The number line is cut in equal pieces, about as many as there are bands
    (1,024 at least), and pieces are halves of pieces twice as wide, and so on.
    A band is listed under the few widest pieces that make it up, two for each width
    at most, so overlapping and open bands take no more room than others. A row
    meets the bands of its own piece of each width that is in use: an equi-join,
    which Spark broadcasts or sorts by the size of the band table, in place of
    all pairs.
    """
    edges = bands.agg(F.min(low).cast("double").alias("start"), F.max(high).cast("double").alias("end"), F.count(F.lit(1)).alias("n")).first()
    if edges["n"] == 0 or edges["start"] is None or edges["end"] is None:
        return df.join(bands, F.lit(False), "inner")
    depth = max(10, (edges["n"] - 1).bit_length())
    width = max((edges["end"] - edges["start"]) / 2**depth, 1e-9)
    piece = lambda column: F.floor((column - F.lit(edges["start"])) / F.lit(width)).cast("long")
    # Bands that end before they begin hold nothing.
    listed = bands.where(F.col(low) <= F.col(high)).withColumn("_at", F.explode(_widest_pieces(piece(F.col(low)), piece(F.col(high)), depth + 1)))
    listed = listed.select("*", F.col("_at.level").alias("_level"), F.col("_at.piece").alias("_piece")).drop("_at")
    levels = sorted(row["_level"] for row in listed.select("_level").distinct().collect())  # at most depth + 2 numbers
    if not levels:
        return df.join(bands, F.lit(False), "inner")
    # A row outside all bands has no piece.
    rows = df.withColumn("_value", value).where(F.col("_value").between(edges["start"], edges["end"]))
    own = piece(F.col("_value"))
    places = [F.struct(F.lit(level).alias("level"), F.shiftright(own, level).alias("piece")) for level in levels]
    rows = rows.withColumn("_at", F.explode(F.array(*places)))
    rows = rows.select("*", F.col("_at.level").alias("_level"), F.col("_at.piece").alias("_piece")).drop("_at")
    joined = rows.join(listed, ["_level", "_piece"])
    return joined.where(F.col("_value").between(F.col(low), F.col(high))).drop("_level", "_piece", "_value")


def _widest_pieces(first: Column, last: Column, depth: int) -> Column:
    """The pieces, as level (how often it was doubled) and number, that make up a run of the narrowest ones."""
    node = "array<struct<level:int,piece:bigint>>"
    start = F.struct(first.alias("a"), last.alias("b"), F.array().cast(node).alias("nodes"))

    def step(state: Column, level: Column) -> Column:
        a, b = state["a"], state["b"]
        take_a = (a <= b) & (a % 2 == 1)
        take_b = (a <= b) & (b % 2 == 0) & ~(take_a & (a == b))
        one = lambda number: F.array(F.struct(level.alias("level"), number.alias("piece")))
        nodes = F.concat(state["nodes"], F.when(take_a, one(a)).otherwise(F.array().cast(node)), F.when(take_b, one(b)).otherwise(F.array().cast(node)))
        up_a, up_b = a + F.when(take_a, 1).otherwise(0), b - F.when(take_b, 1).otherwise(0)
        # An empty run stays empty: halving must not let its ends meet again.
        up_b = F.when(up_a > up_b, F.lit(-1).cast("long")).otherwise(up_b)
        return F.struct(F.shiftright(up_a, 1).alias("a"), F.shiftright(up_b, 1).alias("b"), nodes.alias("nodes"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(depth)), start, step, lambda state: state["nodes"])


def next_at_or_after(
    days: DataFrame, day: str, candidates: DataFrame, candidate: str, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """For each row, the first candidate date that is not before its date.

    Both sides are put in one ordered list and the candidate is carried
    backwards over it, so nothing is compared pairwise.
    """
    left = days.withColumn("_at", F.col(day)).withColumn("_here", F.lit(None).cast("date"))
    right = candidates.select(*by, F.col(candidate).alias("_at"), F.col(candidate).alias("_here"))
    together = left.withColumn("_is_day", F.lit(True)).unionByName(right.withColumn("_is_day", F.lit(False)), allowMissingColumns=True)
    # Latest first; on one date the candidate comes before the rows that use it.
    # The hash only tells equal dates apart, so that a date with very many rows can be split.
    order = [down("_at"), F.col("_is_day"), F.xxhash64(*days.columns)]
    found = ordered_columns(together, by, order, last_seen={name: F.col("_here")})
    return found.where("_is_day AND " + f"`{name}` IS NOT NULL").drop("_at", "_here", "_is_day")


def with_next(df: DataFrame, date: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """The next date of the same table, null for the last. Dates must be distinct within ``by``."""
    return ordered_columns(df, by, [down(date)], previous={name: F.col(date)})


def reporting_detail(days: DataFrame, date: str) -> DataFrame:
    """Reporting month (that of the next reporting day) and number of the day in it.

    The last day of the table has no next one and is left out.
    """
    window = Window.partitionBy("_next").orderBy(date)  # a month holds at most 31 days
    following = with_next(days.select(date).distinct(), date, "_after").where(F.col("_after").isNotNull())
    month = following.select(F.col(date), F.date_format("_after", "MMM-yy").alias("reporting_month"), F.trunc("_after", "month").alias("_next"))
    return month.withColumn("reporting_day", F.row_number().over(window)).drop("_next")
