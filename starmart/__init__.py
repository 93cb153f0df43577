"""starmart: normalised care-encounter tables -> star schema and reports, on Spark.

Layout
------
``sources``    raw reads, staging of the driver tables, seed rows, generator, calendar
``functions``  column expressions (date keys, age bands, code categories, exact ratios)
``operators``  reusable Spark operators (dense keys, windowed existence, upsert)
``plans``      dimension / fact / bridge builds, reports, quality checks, refresh
``streaming``  Structured Streaming feed of the same load
``oracle``     DuckDB SQL text for every registered query (correctness oracle)
"""

__all__ = ["session", "schemas"]
