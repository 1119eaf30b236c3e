"""Runs queries next to their SQL counterpart in DuckDB and compares the results."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return connection


def _normal(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float) or "float" in type(value).__name__:
        return f"{float(value):.12g}"
    if "int" in type(value).__name__:
        return f"{int(value)}"
    if type(value).__name__ == "bool_":
        return str(bool(value))
    return str(value)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_normal(r[i]) for i in order) for r in data)


def difference(spark, sf_dir: str, run, sql: str) -> str | None:
    df = run(spark, sf_dir)
    got = rows(df.columns, df.collect())
    relation = duck(sf_dir).sql(sql)
    want = rows(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    odd = {c: (k, kinds[c]) for c, k in df.dtypes if same.get(k) != kinds[c]}
    if odd:
        return f"types {odd}"
    if got != want:
        have, need = set(got), set(want)
        extra = [r for r in got if r not in need][:3]
        lacking = [r for r in want if r not in have][:3]
        return f"{len(got)} rows, expected {len(want)}; only here {extra}; only there {lacking}"
    return None if got else "no rows"
