"""Compare registered queries with their check SQL in DuckDB.

Run as ``python -m tests.check [directory] [query ...]``.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

import __spark_entry__ as entry
from wearline.session import local_session


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows with columns by name, as sorted text tuples."""
    df = df[sorted(df.columns)]
    columns = []
    for name in df.columns:
        values = df[name]
        if pd.api.types.is_float_dtype(values) and values.dropna().map(float.is_integer).all():
            values = values.astype("Int64").astype(object)
        if pd.api.types.is_datetime64_any_dtype(values):
            values = values.map(lambda v: None if pd.isna(v) else v.isoformat(sep=" "))
        columns.append([None if v is None or v is pd.NA or v != v else str(v) for v in values])
    return sorted(zip(*columns), key=lambda row: tuple((v is not None, v or "") for v in row))


def differences(spark, con, sf_dir: str, name: str) -> str | None:
    """What differs between the query and its check SQL, ``None`` when they agree."""
    got_df = entry.queries()[name](spark, sf_dir)
    got = got_df.toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if len(got) else "no rows"
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return None
    only_a, only_b = sorted(set(a) - set(b), key=str)[:2], sorted(set(b) - set(a), key=str)[:2]
    return f"rows {len(a)} vs {len(b)}; only here {only_a}; only there {only_b}"


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark, con = local_session(), duck(sf_dir)
    names = args[1:] or list(entry.queries())
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        checked = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {name} [{checked}] {time.time() - start:.1f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
