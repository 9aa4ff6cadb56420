"""JSON outputs: files, one document of several tables, documents by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyloom.operators.ordered import ordered_columns, row_index


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_json_by_key(df: DataFrame, key: str, path: str, mode: str = "errorifexists") -> None:
    """One folder of JSON lines for each key value; tasks write side by side, a hot key over several files."""
    df.hint("rebalance", key).write.mode(mode).partitionBy(key).json(path)


def write_json_tables(tables: Mapping[str, DataFrame], path: str, mode: str = "errorifexists") -> None:
    """Several results under one folder: the form of a bundle for results of any size."""
    for name, table in tables.items():
        write_json_lines(table, f"{path.rstrip('/')}/{name}", mode)


def json_bundle(tables: Mapping[str, DataFrame], label: str = "table") -> DataFrame:
    """Several results as one document of rows: table, position in it, and the row as a JSON object.

    Rows are in the order of their columns from left to right. Written in the order
    of table and position (``write_json_document``) they are the document, whatever its size.
    """
    pieces = None
    for name, table in tables.items():
        columns = [F.col(f"`{c}`") for c in table.columns]
        placed = row_index(table, columns, "_position")
        piece = placed.select(F.lit(name).alias(label), F.col("_position").alias("position"), F.to_json(F.struct(*columns)).alias("json"))
        pieces = piece if pieces is None else pieces.unionByName(piece)
    return pieces


def json_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """For each key its rows as JSON objects, with their position in the order of ``order`` and the other columns."""
    columns = [*order, *(c for c in df.columns if c not in order and c != key)]
    placed = ordered_columns(df, [key], [F.col(f"`{c}`") for c in columns], row_number="_position")
    return placed.select(key, F.col("_position").alias("position"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("json"))


def write_json_document(document: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Lines of JSON in the order of the document's first two columns; the files in name order hold them in order."""
    first, second = document.columns[:2]
    document.repartitionByRange(first, second).sortWithinPartitions(first, second).select("json").write.mode(mode).text(path)
