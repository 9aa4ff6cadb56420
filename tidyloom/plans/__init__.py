"""Whole data-preparation jobs, grouped by subject; each takes raw frames and returns results."""
