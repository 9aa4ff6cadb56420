"""Tests, branches and value replacement."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    "==": operator.eq,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "in": lambda column, values: column.isin(list(values)),
}


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def predicate(column: Column | str, op: str, value: Any) -> Column:
    """A test chosen by the name of its operator."""
    if op not in _COMPARE:
        raise NotImplementedError(f"no predicate is known for {op!r}")
    return _COMPARE[op](as_column(column), value)


def if_else(column: Column | str, value: Any, then: Any, otherwise: Any, op: str = "==") -> Column:
    """``then`` where the test holds; ``otherwise`` where it fails or is null."""
    return F.when(predicate(column, op, value), F.lit(then)).otherwise(F.lit(otherwise))


def first_match(branches: Iterable[tuple[Column, Any]], default: Any = None) -> Column:
    """The value of the first branch whose test holds, else the default (null)."""
    result = None
    for test, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        result = F.when(test, value) if result is None else result.when(test, value)
    if result is None:
        return F.lit(default)
    return result if default is None else result.otherwise(default if isinstance(default, Column) else F.lit(default))


def three_state(true_when: Column, false_when: Column) -> Column:
    """True, false, or null where neither test holds."""
    return first_match([(true_when, True), (false_when, False)])


def replace_values(column: Column | str, mapping: Mapping[Any, Any]) -> Column:
    """Swap whole values by a mapping and keep the others."""
    column = as_column(column)
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), column) if pairs else column


def label_null(column: Column | str, label: Column | str, text: str = "Not provided") -> Column:
    """A fixed text where ``column`` is null, else ``label``."""
    return F.when(as_column(column).isNull(), F.lit(text)).otherwise(as_column(label))


def banded(value: Column | str, bands: Iterable[tuple[Any, Any, Any]], default: Any = None) -> Column:
    """Label of the first band ``(low, high, label)`` that holds the value, ends included.

    ``None`` as an end leaves that side open.
    """
    value = as_column(value)

    def inside(low, high):
        if low is None:
            return value <= high
        return value >= low if high is None else value.between(low, high)

    return first_match([(inside(low, high), label) for low, high, label in bands], default)


def below(value: Column | str, steps: Iterable[tuple[Any, Any]], default: Any) -> Column:
    """Label of the first step ``(upper, label)`` with ``value < upper``."""
    value = as_column(value)
    return first_match([(value < upper, label) for upper, label in steps], default)
