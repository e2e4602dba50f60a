"""Queries over the given test tables, each with SQL that yields the same rows."""
