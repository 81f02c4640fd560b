"""Operators whose Spark form takes some care: joins, numbering, changes, audit, checks."""
