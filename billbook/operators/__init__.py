"""Relational operators of the lakehouse, each DataFrame(s) -> DataFrame."""
