"""Queries over the given tables, with the same results stated as plain SQL."""
