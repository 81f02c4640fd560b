"""Declared tables, loading, staging and written snapshots."""
