"""Operators run over the given tables, each with its SQL twin."""

from tidyloom.queries import registry
from tidyloom.queries import bank_jobs, columns, joins, reshape, retail_jobs, school_jobs, sources, staff_jobs, totals, windows  # noqa: F401  (registration)

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
