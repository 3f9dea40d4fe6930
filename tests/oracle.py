"""Runs a query in Spark and its SQL in DuckDB and compares rows in any order."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        number = float(value)
        return "nan" if math.isnan(number) else f"{number:.9g}"
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(table, key=repr)


def compare(query, spark, directory, con=None):
    """(rows, problem); problem is None when both sides agree."""
    con = con or connect(directory)
    frame = query(spark, directory)
    got_columns, got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(query.oracle)
    want_columns, want = normal([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return len(got), f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return len(got), f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return len(got), f"first difference\n  spark  {a}\n  duckdb {b}"
    return len(got), None


if __name__ == "__main__":
    from sparrowmill.registry import all_queries
    from sparrowmill.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    session = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8",
                            spark__driver__memory="12g")
    session.sparkContext.setLogLevel("ERROR")
    where = f"/root/testdata/sf{sf}"
    duck = connect(where)
    bad = 0
    for name, q in all_queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            rows, problem = compare(q, session, where, duck) if q.oracle else (-1, "no oracle")
        except Exception as error:  # report and go on with the next query
            rows, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:28s} rows={rows:7d} "
              f"{time.time() - start:6.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
