"""Compare the registered queries with their SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value: object) -> str:
    if value is None:
        return "\0"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return "\0" if math.isnan(value) else repr(float(value))
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def normal_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns sorted by name, as text, in order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str, show: int = 3) -> list[str]:
    """What differs between a Spark result and a SQL result; empty when nothing does."""
    got = normal_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = normal_rows(names, result.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return [f"columns {sorted(spark_df.columns)} <> {sorted(names)}"]
    if got == want:
        return []
    left, right = set(got), set(want)
    return [f"{len(got)} rows <> {len(want)} rows", f"columns {sorted(names)}",
            *[f"spark  {r}" for r in sorted(left - right)[:show]],
            *[f"duckdb {r}" for r in sorted(right - left)[:show]]]
