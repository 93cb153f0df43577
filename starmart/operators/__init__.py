"""Reusable Spark operators: dense keys, windowed existence, keyed upsert."""
