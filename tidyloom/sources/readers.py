"""CSV reads with a given or found schema, differently headed and encoded files, stacked frames."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyloom.functions.text import extract
from tidyloom.settings import stored


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | T.StructType | None = None,
    *,
    separator: str = ",",
    null_marker: str | None = None,
    date_layout: str | None = None,
    encoding: str = "UTF-8",
    folders_hold_labels: bool = False,
) -> DataFrame:
    """Read headed CSV files, one or many, by a given schema; without one, types are found in a pass before (``inferred_schema``).

    Bytes that are no text in ``encoding`` become replacement characters rather
    than an error. A row that does not fit the schema ends the job.
    """
    if schema is None:
        schema = inferred_schema(spark, path, separator=separator, null_marker=null_marker or "", date_layout=date_layout or "yyyy-MM-dd")
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", separator)
        .option("encoding", encoding)
        .option("mode", "FAILFAST")
        .option("enforceSchema", True)
    )
    if null_marker is not None:
        reader = reader.option("nullValue", null_marker)
    if date_layout is not None:
        reader = reader.option("dateFormat", date_layout)
    if folders_hold_labels:
        reader = reader.option("recursiveFileLookup", True)
    return reader.csv(path if isinstance(path, str) else list(path))


# The types a column of text can take, from the narrowest on, with the test of one value.
_TYPES = [
    ("boolean", lambda text: F.lower(text).isin("true", "false")),
    ("long", lambda text: text.rlike(r"^[+-]?\d+$") & text.try_cast("long").isNotNull()),
    ("double", lambda text: text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")),
]


def inferred_schema(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    separator: str = ",",
    null_marker: str = "",
    date_layout: str = "yyyy-MM-dd",
    share: float = 1.0,
) -> T.StructType:
    """The schema of headed CSV files, from one pass over a share of their rows.

    A column takes the narrowest of boolean, long, double and date (by
    ``date_layout``) that all its values fit, double where whole and broken numbers
    meet, and string otherwise, or where it has no value. With ``share`` below 1
    rows are drawn by a hash of their cells; a value in another row that does not
    fit then ends the read with an error, see ``read_csv``. One row of counts comes
    to the driver.
    """
    raw = spark.read.option("header", True).option("sep", separator).option("nullValue", null_marker)
    raw = raw.csv(path if isinstance(path, str) else list(path))
    cells = [F.trim(F.col(f"`{name}`")) for name in raw.columns]
    rows = raw if share >= 1 else raw.where(F.pmod(F.xxhash64(*cells), F.lit(1 << 20)) < int(share * (1 << 20)))
    tests = [*_TYPES, ("date", lambda text: F.try_to_timestamp(text, F.lit(date_layout)).isNotNull())]
    counts = [F.count(cell).alias(f"n{i}") for i, cell in enumerate(cells)]
    counts += [F.count_if(test(cell)).alias(f"{kind}{i}") for i, cell in enumerate(cells) for kind, test in tests]
    found = rows.agg(*counts).first()
    schema = T.StructType()
    for i, name in enumerate(raw.columns):
        fits = [kind for kind, _ in tests if found[f"n{i}"] and found[f"{kind}{i}"] == found[f"n{i}"]]
        schema.add(name, fits[0] if fits else "string")
    return schema


def read_headed(spark: SparkSession, path: str | Sequence[str], name_map: Mapping[str, str], columns: Sequence[str], *, separator: str = ",") -> DataFrame:
    """CSV files whose columns differ in spelling, number and order, under common names, as strings, in one scan.

    Of each file the first line is read for its header; ``name_map`` gives the
    common name of each spelling. A row's cells are then picked by its file's
    places of the names. A name that a file lacks is null there, spellings that the
    map does not know are left out, and two of one name in a file are an error.
    ``file_path`` tells where a row came from.
    """
    paths = path if isinstance(path, str) else list(path)
    lines = spark.read.text(paths, recursiveFileLookup=True).select("value", file_path().alias("file_path"), F.col("_metadata.file_block_start").alias("at"))
    # The first block of a file is read by one task from its first line on.
    first = lines.where("at = 0").withColumn("_id", F.monotonically_increasing_id()).groupBy("file_path").agg(F.min_by("value", "_id").alias("line"))
    spelled = F.transform(F.split("line", re.escape(separator), -1), lambda cell: F.regexp_replace(F.trim(cell), r'^"|"$|^\ufeff', ""))
    common = F.create_map(*[F.lit(text) for pair in name_map.items() for text in pair])
    headers = first.select("file_path", F.transform(spelled, lambda cell: F.try_element_at(common, cell)).alias("names"))
    twice = F.size(F.array_compact("names")) != F.size(F.array_distinct(F.array_compact("names")))
    checked = F.when(twice, F.raise_error(F.concat(F.lit("two columns of one name in "), "file_path"))).otherwise(F.col("names"))
    headers = stored(headers.select("file_path", checked.alias("names")))
    width = headers.agg(F.max(F.size("names"))).first()[0] or 1
    cells = [f"c{i}" for i in range(width)]
    raw = spark.read.schema(", ".join(f"{cell} string" for cell in cells)).option("header", True).option("sep", separator)
    raw = raw.option("enforceSchema", True).option("recursiveFileLookup", True).csv(paths).select(F.array(*cells).alias("cells"), file_path().alias("file_path"))
    place = lambda name: F.nullif(F.array_position("names", name), F.lit(0))
    placed = raw.join(headers, "file_path")
    return placed.select(*[F.get("cells", (place(name) - 1).cast("int")).alias(name) for name in columns], "file_path")


def read_lines(spark: SparkSession, path: str | Sequence[str], fallback: str = "ISO-8859-1") -> DataFrame:
    """Lines of text files, each file by its own encoding: UTF-8 where all its bytes are, else ``fallback``.

    Columns: ``file_path``, ``line``, ``encoding``, and ``n_replaced``, how many
    characters of the line a reading as UTF-8 would have replaced. Lines are
    judged where they are read; one row a file is joined back.
    """
    raw = spark.read.text(path if isinstance(path, str) else list(path), recursiveFileLookup=True).select("value", file_path().alias("file_path"))
    valid = raw.groupBy("file_path").agg(F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"))
    lines = raw.join(valid, "file_path")
    line = F.when(F.col("is_utf8"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), fallback))
    mended = F.make_valid_utf8("value")
    replaced = F.when(F.col("is_utf8"), 0).otherwise(F.length(mended) - F.length(F.replace(mended, F.lit("\ufffd"), F.lit(""))))
    return lines.select("file_path", line.alias("line"), F.when(F.col("is_utf8"), "UTF-8").otherwise(fallback).alias("encoding"), replaced.alias("n_replaced"))


def file_path() -> Column:
    return F.col("_metadata.file_path")


def file_name() -> Column:
    return F.col("_metadata.file_name")


def file_month(path: Column, pattern: str, year: int) -> Column:
    """First day of the month whose number the file name carries; a file without one is January's."""
    month = F.coalesce(extract(path, pattern), F.lit("1"))
    return F.make_date(F.lit(year), month.cast("int"), F.lit(1))


def file_code(name: Column, start: int, length: int) -> Column:
    """Characters cut from a file name; ``start`` counts from 0."""
    return F.substring(name, start + 1, length)


def labelled_union(parts: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Stack frames (sheets, files) by column name and keep where each row came from."""
    return stack([frame.withColumn(label, F.lit(text)) for text, frame in parts.items()])


def labelled_rows(df: DataFrame, label: str, parts: Mapping[str, Any], column: str) -> DataFrame:
    """The parts of one frame, each the rows that have one value of ``column``, with their label: one scan for all. Other rows drop out."""
    named = F.create_map(*[F.lit(x) for text, value in parts.items() for x in (value, text)])
    return df.where(F.col(column).isin(*parts.values())).withColumn(label, F.try_element_at(named, F.col(column)))


def stack(frames: Sequence[DataFrame], *, fill_missing: bool = False) -> DataFrame:
    """Union by name; with ``fill_missing`` a column that a frame lacks is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=fill_missing)
    return result
