"""Compare every registered query with its SQL counterpart: ``python -m tests.oracle FOLDER [NAME...]``."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

from driver_queries import QUERIES, SQL


def shown(value):
    if isinstance(value, (float, Decimal)):
        return f"{float(value):.6f}"
    if hasattr(value, "isoformat"):
        return value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()
    return str(value)


def normal(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(shown(row[i]) for i in order) for row in rows)


def tables(folder: str):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def difference(spark, folder: str, name: str, con) -> str:
    """Empty when both sides agree."""
    df = QUERIES[name](spark, folder)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        return "" if got else "no rows"
    cursor = con.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    want = normal(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {df.columns} against {columns}"
    if not want:
        return "no rows to compare"
    if got != want:
        extra, lacking = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        return f"{len(got)} rows against {len(want)}; only Spark {extra}; only SQL {lacking}"
    return ""


if __name__ == "__main__":
    from priceloom.session import local_session

    session, where = local_session(8), sys.argv[1]
    database = tables(where)
    failed = 0
    for query_name in sys.argv[2:] or QUERIES:
        start = time.perf_counter()
        try:
            problem = difference(session, where, query_name, database)
        except Exception as error:  # report all queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {time.perf_counter() - start:6.2f}s {query_name} {problem}", flush=True)
    print(f"{failed} failed")
