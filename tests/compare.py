"""Compare a Spark result with a DuckDB result: columns, types and values, regardless of order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def differences(spark_df, con, sql: str) -> list[str]:
    spark_columns, spark_rows = _bag(spark_df.columns, spark_df.collect())
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    duck_columns, duck_rows = _bag(list(described), con.execute(sql).fetchall())
    if spark_columns != duck_columns:
        return [f"columns {spark_columns} vs {duck_columns}"]
    found = []
    for name, kind in spark_df.dtypes:
        if SPARK_TO_DUCK.get(kind, kind) != described[name]:
            found.append(f"type of {name}: {kind} vs {described[name]}")
    if spark_rows != duck_rows:
        found.append(
            f"rows {sum(spark_rows.values())} vs {sum(duck_rows.values())}; "
            f"only Spark {list((spark_rows - duck_rows).items())[:3]}; "
            f"only DuckDB {list((duck_rows - spark_rows).items())[:3]}"
        )
    return found
