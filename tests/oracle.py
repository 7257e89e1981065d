"""Spark and DuckDB rows in one form."""

from __future__ import annotations

import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def value(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return tuple(map(value, v)) if isinstance(v, list | tuple) else v


def same(df, relation) -> None:
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    place = [relation.columns.index(c) for c in columns]
    got = sorted((tuple(value(r[c]) for c in columns) for r in df.collect()), key=str)
    want = sorted((tuple(value(r[i]) for i in place) for r in relation.fetchall()), key=str)
    assert got == want
