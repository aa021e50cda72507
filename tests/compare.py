"""Run registered queries against DuckDB and report differences.

``python tests/compare.py [folder] [name-part ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, repr(float(value) + 0.0))
    return (3, str(value))


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    return type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        sorted(tuple(normal(r[i]) for i in order) for r in rows),
        {
            columns[i]: {kind(r[i]) for r in rows if r[i] is not None and normal(r[i])[0]}
            for i in order
        },
    )


def difference(df, con, sql: str) -> str | None:
    """First difference between a DataFrame and a SQL text, or None."""
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.sql(sql)
    theirs = rows_of(result.columns, result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    kinds = {
        c: (ours[2][c], theirs[2][c])
        for c in ours[0]
        if ours[2][c] and theirs[2][c] and ours[2][c] != theirs[2][c]
    }
    if kinds:
        return f"kinds {kinds}"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours[1])} rows, first {wrong[0]}"
    return None


def main() -> int:
    from fieldmill.catalog import Tables, load_all
    from fieldmill.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session(
        "compare",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(folder)
    bad = 0
    for name, entry in load_all().items():
        if parts and not any(p in name for p in parts):
            continue
        started = time.perf_counter()
        try:
            df = entry.build(Tables(spark, folder))
            if entry.sql is None:
                note = f"rows only: {df.count()}"
            else:
                note = difference(df, con, entry.sql)
                bad += note is not None
        except Exception as error:  # noqa: BLE001
            note, bad = f"{type(error).__name__}: {str(error)[:600]}", bad + 1
        print(f"{name:34s} {time.perf_counter() - started:6.2f}s  {note or 'ok'}", flush=True)
    print("differences:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main() else 0)
