"""Exact metric range join of vectors: pivots partition the space, the triangle inequality bounds replication.

Vectors on the unit sphere with a cosine of at least c lie within a distance of
sqrt(2 - 2c). Each vector belongs to the cell of its nearest pivot. Its distance
to the border of another pivot's cell is at least
(d(x,q)**2 - d(x,p)**2) / (2 d(p,q)), with p its own pivot and q the other;
where that is within the join's distance, the vector also goes to q's cell. One
of the two suffices, so copies go to cells of higher number only. Cells
then join alone. Equal vectors are one node with a count.

How many pivots pay depends on the data: in many dimensions and without
clusters, borders are near everywhere and every copy costs. So numbers of
pivots from 1 up are tried on a bounded sample, and the one with the least
estimated work is taken. The result is the same for every number.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyloom.llm.store import connected, saved

#: Rows of one side of a comparison in a task; a cell with more is compared block by block, each pair of blocks in a task.
BLOCK_ROWS = 4096
#: Pivots at most (every task gets them), and vectors that their number is tried on.
MOST_PIVOTS, TRIAL_ROWS = 1024, 2000
_SLACK = 1e-9
_CHUNK = 512


def _unit(column) -> np.ndarray:
    """Rows of a list column at length 1, in double precision."""
    rows = len(column)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # first by the largest component, so that no square overflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cells(x: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and which cells it goes to."""
    at = np.arange(len(x))
    between = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
    squares = np.maximum(0, 2 - 2 * x @ pivots.T)
    home = squares.argmin(axis=1)
    gap = between[home]
    border = (squares - squares[at, home][:, None]) / (2 * np.maximum(gap, 1e-12))
    near = ((border <= reach + _SLACK) | (gap < 1e-6)) & (np.arange(len(pivots)) > home[:, None])
    near[at, home] = True
    return home, near


def pivots_that_pay(trial: np.ndarray, total: int, reach: float, most: int, block_rows: int) -> np.ndarray:
    """The first 1, 4, 16, ... vectors of the trial, by estimated comparisons and copies.

    A comparison counts 1; a copy of a row counts as much as 200 comparisons for
    each task it is sent to.
    """
    best, chosen = None, trial[:1]
    size = 1
    while size <= min(most, len(trial)):
        home, near = _cells(trial, trial[:size], reach)
        rows = near.sum(axis=0) * (total / len(trial))
        own = np.bincount(home, minlength=size) * (total / len(trial))
        work = float((own * (rows - own / 2)).sum() + 200 * (rows * np.ceil(np.maximum(rows, 1) / block_rows)).sum() + 20 * total * size)
        if best is None or work < best:
            best, chosen = work, trial[:size]
        size *= 4
    return chosen


def _spread(pivots: np.ndarray, reach: float):
    """Each vector in its home cell, and in the cells beside it whose border is near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            home, near = _cells(_unit(batch.column(1)), pivots, reach)
            row, cell = np.nonzero(near)
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cell, pa.int64()), pa.array(home[row] == cell)], names=["node", "vector", "copies", "cell", "home"])

    return run


def _least_reached(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id reachable inside a block, for its rows and its columns."""
    nobody = np.iinfo(np.int64).max
    while True:
        new_columns = columns.copy()
        new_rows = rows.copy()
        for lo in range(0, len(rows), _CHUNK):
            part = linked[lo : lo + _CHUNK]
            new_rows[lo : lo + _CHUNK] = np.minimum(rows[lo : lo + _CHUNK], np.where(part, columns, nobody).min(axis=1, initial=nobody))
            new_columns = np.minimum(new_columns, np.where(part, new_rows[lo : lo + _CHUNK, None], nobody).min(axis=0, initial=nobody))
        if (new_rows == rows).all() and (new_columns == columns).all():
            return rows, columns
        rows, columns = new_rows, new_columns


def _compared(cosine: float):
    """What block i and block j of a cell have in common: partners of each node, and for linked nodes the smallest id reached."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        _, i, j = (k.as_py() for k in key)
        block = part.column("block").to_numpy()
        left, right = (part.filter(pa.array(block == b)) for b in (i, j))
        x, y = (_unit(side.column("vector")) if side.num_rows else np.zeros((0, 1)) for side in (left, right))
        nodes, links, roots = [], [], []
        if len(x) and len(y):
            # In single precision with a margin first, then what may be linked in double precision.
            maybe = x.astype(np.float32) @ y.astype(np.float32).T >= cosine - 1e-4
            at_x, at_y = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
            linked = x[at_x] @ y[at_y].T >= cosine
            a, b = left.column("node").to_numpy()[at_x], right.column("node").to_numpy()[at_y]
            linked &= a[:, None] != b[None, :]
            linked &= left.column("home").to_numpy()[at_x][:, None] | right.column("home").to_numpy()[at_y][None, :]
            n_a, n_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
            copies_a, copies_b = left.column("copies").to_numpy()[at_x], right.column("copies").to_numpy()[at_y]
            for lo in range(0, len(a), _CHUNK):
                chunk = linked[lo : lo + _CHUNK]
                n_a[lo : lo + _CHUNK] = (chunk * copies_b).sum(axis=1)
                n_b += (chunk * copies_a[lo : lo + _CHUNK, None]).sum(axis=0)
            root_a, root_b = _least_reached(linked, a, b)
            sides = [(a, n_a, root_a)] if i == j else [(a, n_a, root_a), (b, n_b, root_b)]
            for side, counts, root in sides:
                some = counts > 0
                nodes.append(side[some])
                links.append(counts[some])
                roots.append(root[some])
        columns = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in (nodes, links, roots)]
        return pa.table(columns, names=["node", "links", "root"])

    return run


def linked_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cosine: float = 0.95,
    block_rows: int = BLOCK_ROWS,
    most_pivots: int = MOST_PIVOTS,
) -> DataFrame:
    """The id, ``n_links``, ``component_id`` and ``kept`` for every row, linked where the cosine is at least ``cosine``.

    Cosines are computed in double precision. ``n_links`` counts the other
    vectors linked directly, ``component_id`` is the smallest id that links
    reach, and ``kept`` marks the row that has it. Pivots are a bounded sample
    of the vectors, by a hash of the id; they decide where vectors are compared,
    never which.

    Defined cases: a vector that is null, empty or zero or has null or
    non-finite components links with nothing, as does a row with a null id
    (``kept`` true); vectors of different lengths never link; a repeated row is
    a vector of its own, so equal rows are each other's links. Other columns are ignored.
    """
    v = F.col(vector_column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    usable = F.coalesce((F.size(v) > 0) & finite & F.col(id_column).isNotNull(), F.lit(False))
    rows = saved(vectors.select(F.col(id_column).cast("long").alias("id"), F.when(usable, v).alias("vector")), "vectors")
    full = rows.where(F.col("vector").isNotNull())
    # Equal vectors are one node, named by the smallest id.
    nodes = saved(full.groupBy("vector").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")).withColumn("width", F.size("vector")), "nodes")
    reach, results = sqrt(2 - 2 * cosine), None
    for width, total in sorted(tuple(r) for r in nodes.groupBy("width").count().collect()):  # only vectors of one length meet
        part = nodes.where(F.col("width") == width).select("node", "vector", "copies")
        trial = _unit(part.orderBy(F.xxhash64("node"), "node").limit(max(TRIAL_ROWS, most_pivots)).toArrow().column("vector"))
        pivots = pivots_that_pay(trial, total, reach, most_pivots, block_rows)
        kind = part.schema["vector"].dataType.simpleString()
        spread = part.mapInArrow(_spread(pivots, reach), f"node long, vector {kind}, copies long, cell long, home boolean")
        spread = saved(spread, "cells")
        sizes = spread.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))  # a row for each pivot at most
        sized = spread.join(F.broadcast(sizes), "cell").withColumn("blocks", F.ceil(F.col("rows") / block_rows).cast("long"))
        sized = sized.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        pair = lambda other: F.struct(F.least("block", other).alias("i"), F.greatest("block", other).alias("j"))
        pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), pair)
        placed = sized.select("node", "vector", "copies", "home", "block", "cell", F.explode(pairs).alias("at"))
        placed = placed.select("node", "vector", "copies", "home", "block", "cell", "at.i", "at.j")
        found = placed.groupBy("cell", "i", "j").applyInArrow(_compared(cosine), "node long, links long, root long")
        results = found if results is None else results.unionByName(found)
    if results is None:
        results = rows.select(F.col("id").alias("node"), F.col("id").alias("links"), F.col("id").alias("root")).limit(0)
    results = saved(results, "results")
    links = results.groupBy("node").agg(F.sum("links").alias("links"))
    groups = saved(connected(results, "node", "root"), "groups")
    found = nodes.join(links, "node", "left").join(groups, "node", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
    )
    out = full.join(saved(found, "found"), "vector").select("id", "n_links", "component_id")
    out = out.unionByName(rows.where(F.col("vector").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_column), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
