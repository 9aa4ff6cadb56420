"""Amounts written as text, ratios and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidyloom.functions.predicates import as_column, first_match
from tidyloom.functions.text import extract, replace_first, strip_end, strip_prefix

# Magnitude letters.
MAGNITUDES = {"K": 1_000, "M": 1_000_000, "B": 1_000_000_000}


def magnitude(column: Column | str) -> Column:
    """Factor named by the last letter of a text; 1 without such a letter."""
    column = as_column(column)
    return first_match([(column.endswith(letter), factor) for letter, factor in MAGNITUDES.items()], 1)


def parse_amount(column: Column | str) -> Column:
    """``$1.5M`` to 1500000: first number times its magnitude, cut to a whole number."""
    number = extract(column, r"(\d+\.\d+|\d+)").cast("double")
    return (number * magnitude(column)).cast("long")


def parse_grouped_amount(column: Column | str) -> Column:
    """``1,250K`` to 1250000: the letter is stripped, one thousands comma dropped."""
    number = replace_first(strip_end(column, "".join(MAGNITUDES)), ",", "").cast("double")
    return (number * magnitude(column)).cast("long")


def parse_price(column: Column | str, currency: str = "$") -> Column:
    return strip_prefix(column, currency).cast("double")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient; null for a zero divisor, which plain ``/`` turns into an error."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def cents(column: Column | str) -> Column:
    """Money in whole cents: long sums are exact in whatever order rows arrive."""
    return F.round(as_column(column) * 100).cast("long")
