"""Text: extraction, replacement, trimming, padding, splitting."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyloom.functions.predicates import as_column


def extract(column: Column | str, pattern: str, group: int = 1) -> Column:
    """One regex group of the first match; null (not ``''``) without a match."""
    return F.nullif(F.regexp_extract(as_column(column), pattern, group), F.lit(""))


def group_pieces(column: Column | str, pattern: str, groups: int, usual: Column | None = None) -> Column:
    """The groups of the first match as an array; null or empty without a match.

    One run of the pattern writes all groups with a mark before each, and the
    marks part them. Only a text that holds the mark itself is read group by group.
    ``usual`` gives the same groups in less time for texts of the usual form, and
    null for all others, which are left to the pattern.
    """
    column, mark = as_column(column), "\x01"
    written = F.regexp_replace(column, f"(?s)^.*?(?-s:{pattern}).*$", "".join(f"{mark}${i}" for i in range(1, groups + 1)))
    # Without a match no mark is written and nothing follows the first piece. A test of that would run the pattern again.
    found = F.slice(F.split(written, mark, -1), 2, groups)
    one_by_one = F.array(*[F.regexp_extract(column, pattern, i) for i in range(1, groups + 1)])
    matched = F.when(column.contains(mark), F.when(column.rlike(pattern), one_by_one)).otherwise(found)
    return matched if usual is None else F.coalesce(usual, matched)


def extract_all(column: Column | str, pattern: str) -> Column:
    """All whole matches as an array."""
    return F.regexp_extract_all(as_column(column), F.lit(pattern), F.lit(0))


def replace_first(column: Column | str, old: str, new: str) -> Column:
    """Replace only the first occurrence of a literal text."""
    replacement = new.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(as_column(column), f"(?s)^(.*?)\\Q{old}\\E", "$1" + replacement)


def replace_texts(column: Column | str, pairs: Iterable[tuple[str, str]]) -> Column:
    """Replace literal texts anywhere in the value; none is applied to the output of another.

    A text that contains another is tried first.
    """
    column = as_column(column)
    pairs = sorted(pairs, key=lambda pair: -len(pair[0]))
    if not pairs:
        return column
    pattern = "|".join(re.escape(old) for old, _ in pairs)
    pieces = F.split(column, pattern, -1)
    hits = F.regexp_extract_all(column, F.lit(pattern), F.lit(0))
    swap = F.create_map(*[F.lit(text) for pair in pairs for text in pair])
    joined = F.zip_with(
        pieces,
        hits,
        lambda piece, hit: F.concat(piece, F.coalesce(F.try_element_at(swap, hit), F.lit(""))),
    )
    return F.when(F.size(hits) == 0, column).otherwise(F.array_join(joined, ""))


def remove_text(column: Column | str, text: str) -> Column:
    return F.replace(as_column(column), F.lit(text), F.lit(""))


def strip(column: Column | str, characters: str = " ") -> Column:
    return F.trim(as_column(column), F.lit(characters))


def strip_end(column: Column | str, characters: str) -> Column:
    return F.rtrim(as_column(column), F.lit(characters))


def strip_prefix(column: Column | str, prefix: str) -> Column:
    column = as_column(column)
    return F.when(column.startswith(prefix), F.substring(column, len(prefix) + 1, 2**31 - 1)).otherwise(column)


def pad_left(column: Column | str, width: int, fill: str = "0") -> Column:
    """Pad on the left; a longer text stays whole, where ``lpad`` would cut it."""
    column = as_column(column)
    return F.when(F.length(column) < width, F.lpad(column, width, fill)).otherwise(column)


def part(column: Column | str, separator: str, index: int) -> Column:
    """The piece at a 0-based position; null where there is none."""
    return F.get(F.split(as_column(column), re.escape(separator), -1), F.lit(index))


def trim_strings(df: DataFrame, characters: str = " ") -> DataFrame:
    """Trim every string column."""
    trimmed = {f.name: strip(F.col(f"`{f.name}`"), characters) for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns(trimmed) if trimmed else df


def email(first: Column | str, last: Column | str, host: Column | str) -> Column:
    """``first.last@host.com`` in lower case; null when any part is null."""
    pieces = [as_column(first), F.lit("."), as_column(last), F.lit("@"), as_column(host), F.lit(".com")]
    return F.lower(F.concat(*pieces))


def joined_name(first: Column | str, last: Column | str, separator: str = " ") -> Column:
    return F.concat(as_column(first), F.lit(separator), as_column(last))
