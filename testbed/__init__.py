"""Panels derived from the generated tables, with queries and their SQL checks."""
