"""Intermediate tables in the shared folder, and connected components over them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyloom.settings import scratch_path

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of texts that a task sends to Python at once: it holds them twice, outside the heap and in Python.
BATCH_BYTES = 4 << 20


def saved(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written as Parquet to the folder of ``spark.checkpoint.dir`` and read from there.

    This cuts the lineage: a lost executor costs a re-read, not a re-run, and
    two readers see the same rows.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def bounded_broadcast(frame: DataFrame, rows: int, limit: int) -> DataFrame:
    """Hint a broadcast only where the counted rows are within the bound; else Spark joins by shuffle."""
    return F.broadcast(frame) if rows <= limit else frame


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Let the session send at most so many bytes, and one row more, to Python at once; a smaller bound of its own stays."""
    number, unit = re.match(r"(\d+)([kmgtp]?)", spark.conf.get(_BATCH).strip().lower()).groups()
    if int(number) << 10 * " kmgtp".index(unit or " ") > most:
        spark.conf.set(_BATCH, str(most))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def connected(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``component`` for each end of an edge: component is the smallest node reachable.

    Alternating large-star and small-star steps: each step links every node to
    the least of its neighbours, so chains shorten by a constant factor and a
    few rounds suffice. Minima are combined on the map side and written before
    they are joined, so that AQE can split the join of a hub with many
    neighbours. Loops and null ends are ignored; no edge gives no row.
    """
    a, b = F.col(left), F.col(right)
    pairs = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    pairs = saved(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.distinct(), "large")
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        small = small.select("e.u", F.col("e.m").alias("v")).where(F.col("u") != F.col("v"))
        pairs = saved(small.distinct(), "edges")
        before, mark = mark, _mark(pairs)
        if mark == before:
            break
    roots = pairs.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
