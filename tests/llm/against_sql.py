"""Spark query against its DuckDB SQL, value by value."""
from numbers import Number

import duckdb
import pandas as pd

TABLES = "documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if pd.isna(v):
        return None
    return round(float(v), 6) if isinstance(v, Number) else v


def rows_of(frame, columns):
    return sorted((tuple(map(plain, row)) for row in frame[columns].itertuples(index=False)), key=repr)


def assert_same(spark_df, sql, sf_dir=None, **tables):
    con = duckdb.connect()
    if sf_dir:
        for t in TABLES:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name, frame in tables.items():
        con.register(name, frame)
    want = con.sql(sql).df()
    got = spark_df.toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    got, want = rows_of(got, columns), rows_of(want, columns)
    assert got == want, [x for x in zip(got, want) if x[0] != x[1]][:5]
