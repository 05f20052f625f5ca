"""Compare registered queries with their SQL twins: ``python tests/compare.py [folder] [query …]``."""

from __future__ import annotations

import os
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

import __spark_entry__ as entry
from sluicework.session import build_session
from workload.tables import NAMES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def normal(frame: pd.DataFrame) -> list[tuple]:
    """Rows as text in a fixed order: columns by name, numbers in one notation, every missing value alike."""

    def cell(v: object) -> str:
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "∅"
        if isinstance(v, bool) or type(v).__name__ == "bool":
            return str(bool(v))
        if isinstance(v, (int, float)) or type(v).__module__ == "numpy" and hasattr(v, "item"):
            return repr(round(float(v), 9))
        return str(v)[:10] if type(v).__name__ == "date" else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in row) for row in frame.astype(object).itertuples(index=False, name=None))


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str:
    """Empty when both results are equal, else what differs."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} against {sorted(sql_rows.columns)}"
    a, b = normal(spark_rows), normal(sql_rows)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{x} against {y}"
    return ""


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    chosen = sys.argv[2:] or list(entry.queries())
    for name in chosen:
        start = time.time()
        try:
            got = entry.queries()[name](spark, folder).toPandas()
            took = time.time() - start
            sql = entry.oracle_sql().get(name)
            guard = threading.Timer(60, con.interrupt)
            guard.start()
            problem = difference(got, con.execute(sql).df()) if sql else "no twin"
            guard.cancel()
        except Exception as error:
            took, problem = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem) and problem != "no twin"
        print(f"{'ok  ' if not problem else 'BAD '} {name:32s} {took:6.2f}s {problem[:900]}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
