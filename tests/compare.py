"""Order-free comparison of a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(
        tuple("null" if pd.isna(v) else f"{float(v):.6f}" if isinstance(v, (int, float)) else str(v) for v in row)
        for row in frame.itertuples(index=False)
    )
