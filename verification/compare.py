"""Run the queries and their SQL side by side: ``python -m verification.compare [sf_dir] [names...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

from verification.oracle import oracle_sql
from verification.queries import queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted comparable tuples, columns by name, values exact."""

    def plain(value):
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return None
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        if hasattr(value, "item"):
            value = value.item()
        return value

    names = sorted(frame.columns)
    rows = [tuple(plain(v) for v in row) for row in frame[names].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = pd.DataFrame(result.fetchall(), columns=names, dtype=object)
    actual = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours, theirs = rows_of(actual), rows_of(expected)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}"
    return None


def main(argv: list[str]) -> int:
    from lotwise.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, built = connect(sf_dir), oracle_sql(), queries()
    failed = 0
    for name in argv[1:] or built:
        start = time.time()
        try:
            found = difference(built[name](spark, sf_dir), con, sql[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{name:20} {time.time() - start:6.2f}s {'ok' if found is None else found}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
