"""Queries over the test tables, by name, with their SQL."""
