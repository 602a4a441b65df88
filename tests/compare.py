"""A Spark result against DuckDB over the same tables."""

import datetime
import math
import os
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def cell(x):
    if isinstance(x, (float, Decimal)):
        return None if isinstance(x, float) and math.isnan(x) else round(float(x), 9)
    return x.isoformat() if isinstance(x, datetime.datetime) else x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def assert_same(df, sql, sf_dir):
    result = duck(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(result.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(result.columns, result.fetchall())
