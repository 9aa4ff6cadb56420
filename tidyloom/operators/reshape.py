"""Wide to long, long to wide, splitting, harmonising names, normalising."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyloom.functions import text
from tidyloom.operators.groups import distinct_entity


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None, *, names_to: str = "variable", values_to: str = "value"
) -> DataFrame:
    """Columns to rows; null values stay. Columns of mixed types become strings."""
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    types = {df.schema[c].dataType.simpleString() for c in values}
    if len(types) > 1 and not types <= {"tinyint", "smallint", "int", "bigint", "float", "double"}:
        df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c in values})
    return df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in values], names_to, values_to)


def spread(
    df: DataFrame, index: Sequence[str], names_from: str, values_from: str, names: Sequence[Any], how: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Rows to columns. ``names`` are the wanted columns, in order; no extra job finds them.

    By default a cell takes its single value; a cell with several is an error, so
    that none of them is lost in silence. ``how`` aggregates them instead.
    """
    several = F.raise_error(F.lit(f"several values of {values_from!r} for one row and column"))
    how = how or (lambda value: F.when(F.count(value) > 1, several).otherwise(F.max(value)))
    return df.groupBy(*index).pivot(names_from, list(names)).agg(how(F.col(values_from)))


def spread_count(df: DataFrame, index: Sequence[str], names_from: str, names: Sequence[Any]) -> DataFrame:
    """Counts as columns; a pair that does not occur is null."""
    return df.groupBy(*index).pivot(names_from, list(names)).agg(F.nullif(F.count(F.lit(1)), F.lit(0)))


def split_to_rows(df: DataFrame, column: str, separator: str, name: str | None = None) -> DataFrame:
    """One row for each piece of a text; ``separator`` is a regex."""
    return df.withColumn(name or column, F.explode(F.split(F.col(column), separator, -1)))


def split_groups(df: DataFrame, column: str, pattern: str, names: Sequence[str], usual: Column | None = None) -> DataFrame:
    """Replace a text column by one column for each regex group; all null where the pattern does not match.

    ``usual`` is a quicker way to the groups of most texts (see ``text.group_pieces``).
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != column]
    # One row for each row: the explode keeps the optimizer from copying the
    # regex into every filter and join condition on a group.
    matched = df.withColumn("_groups", F.explode(F.array(text.group_pieces(F.col(f"`{column}`"), pattern, len(names), usual))))
    group = lambda i: F.nullif(F.get("_groups", F.lit(i)), F.lit(""))
    return matched.select(*[group(i).alias(name) for i, name in enumerate(names)], *kept)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def rename_by(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename every column by a rule on its name, such as ``str.lower``."""
    return df.toDF(*[rule(name) for name in df.columns])


def rename_prefix(df: DataFrame, prefix: str, name: str) -> DataFrame:
    """Give one name to the column whose spelling varies but for its first letters."""
    found = [c for c in df.columns if c.startswith(prefix)]
    if len(found) != 1:
        raise ValueError(f"one column should start with {prefix!r}, found {found}")
    return df.withColumnRenamed(found[0], name)


def rename_leading(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """New names for the first columns; the rest keep theirs."""
    return df.toDF(*names, *df.columns[len(names) :])


def harmonize(frames: Sequence[DataFrame], name_map: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """Stack frames whose columns are spelled differently under common names.

    Names are known from the schemas, so this is a projection of each frame,
    with no melting, joining and pivoting of the data. Columns that the map
    does not know are left out; missing ones are null.
    """
    stacked = None
    for frame in frames:
        targets: dict[str, str] = {}
        for spelled in frame.columns:
            target = name_map.get(spelled)
            if target in targets:
                raise ValueError(f"{spelled!r} and {targets[target]!r} both map to {target!r}")
            if target is not None:
                targets[target] = spelled
        part = frame.select(*[F.col(f"`{spelled}`").alias(target) for target, spelled in targets.items()])
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked.select(*columns)


def harmonize_rows(
    df: DataFrame, label: str, cells: str, headers: Mapping[Any, Sequence[str]], name_map: Mapping[str, str], columns: Sequence[str]
) -> DataFrame:
    """Rows of differently headed parts under common names, in one scan.

    ``cells`` is an array of a row's values, ``headers`` gives the spelled names of
    each label's columns. Where ``harmonize`` projects each part and stacks them,
    here the label picks the cell. The other columns stay.
    """
    places: dict[str, list[Column]] = {name: [] for name in columns}
    for part, spelled in headers.items():
        known = [name_map.get(name) for name in spelled]
        for name in columns:
            if known.count(name) > 1:
                raise ValueError(f"two columns of {part!r} map to {name!r}")
            if name in known:
                places[name] += [F.lit(part), F.lit(known.index(name))]
    kept = [F.col(f"`{c}`") for c in df.columns if c != cells]
    pick = lambda name: F.get(cells, F.try_element_at(F.create_map(*places[name]), F.col(label)))
    null = F.lit(None).cast(df.schema[cells].dataType.elementType)
    return df.select(*[(pick(name) if places[name] else null).alias(name) for name in columns], *kept)


def harmonize_by_rule(df: DataFrame, ids: Mapping[str, str], rule: Callable[[str], str | None], names: Sequence[str]) -> DataFrame:
    """Name each measure by a rule on its old name. ``ids`` maps the id columns to their new names.

    Column names are known before any data is read, so no melting and pivoting
    is needed. A measure that the rule does not know is left out.
    """
    known = {old: new for old in df.columns if old not in ids and (new := rule(old)) in names}
    return harmonize([df], {**ids, **known}, [*ids.values(), *[name for name in names if name in known.values()]])


def fill_blanks(df: DataFrame, key: Sequence[str], blanks: Sequence[str]) -> DataFrame:
    """Fill attributes that are given on one row of a key only.

    The given values are taken out into one row for each key and joined back,
    where a forward fill would need the file's row order. Keys without any
    value for the attributes drop out.
    """
    entity = df.groupBy(*key).agg(*[F.max(c).alias(c) for c in blanks]).where(F.coalesce(*[F.col(c).cast("string") for c in blanks]).isNotNull())
    return df.drop(*blanks).join(entity, list(key))


def normalize(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The entity table behind repeated columns: one row for each key."""
    return distinct_entity(df, key, columns)
