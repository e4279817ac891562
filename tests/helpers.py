"""Comparing rows of two engines."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def shown(x) -> str:
    if x is None or x != x:
        return "NULL"
    return f"{x:.9g}" if isinstance(x, float) else str(x)


def rows(columns: list[str], data: list[tuple]) -> list[tuple[str, ...]]:
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(shown(r[i]) for i in order) for r in data)
