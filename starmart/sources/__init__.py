"""Sources and sinks: driver tables, seed rows, generator, calendar, Parquet store."""
