"""Compare a Spark result with a DuckDB result: names, row count, every value."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str, show: int = 3) -> list[str]:
    found = []
    result = con.execute(sql)
    oracle_names = [d[0] for d in result.description]
    oracle_rows = result.fetchall()
    if sorted(spark_df.columns) != sorted(oracle_names):
        return [f"columns {sorted(spark_df.columns)} != {sorted(oracle_names)}"]
    mine = rows_of(spark_df.columns, spark_df.collect())
    theirs = rows_of(oracle_names, oracle_rows)
    if not theirs:
        found.append("oracle result is empty")
    if mine != theirs:
        extra, missing = mine - theirs, theirs - mine
        found.append(
            f"{sum(mine.values())} vs {sum(theirs.values())} rows; columns {sorted(oracle_names)}; "
            f"only spark {list(extra)[:show]}; only oracle {list(missing)[:show]}"
        )
    return found
