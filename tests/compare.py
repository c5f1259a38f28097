"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def table(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=_key)


def spark_table(df) -> tuple[list[str], list[tuple]]:
    return table(df.columns, [tuple(r) for r in df.collect()])


def duck_table(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    return table([d[0] for d in cursor.description], cursor.fetchall())
