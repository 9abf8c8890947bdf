"""Compares a Spark result with DuckDB on the same parquet tables."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.sql(sql)
    names = sorted(result.columns)
    picked = result.project(", ".join(f'"{n}"' for n in names))
    return names, Counter(picked.fetchall())
