"""Readers, lookup tables and writers."""
