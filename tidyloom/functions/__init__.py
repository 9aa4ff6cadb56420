"""Column helpers: each takes columns and returns a ``Column``; no Python UDFs."""
