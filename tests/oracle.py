"""Compare a query with its SQL on the given tables.

    python tests/oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _text(value) -> str:
    if isinstance(value, bool):
        return f"bool:{value}"
    if isinstance(value, float):
        return "float:nan" if math.isnan(value) else f"float:{value!r}"
    if isinstance(value, decimal.Decimal):
        return f"decimal:{value}"
    if isinstance(value, dt.datetime):
        return f"ts:{value.isoformat()}"
    return f"{type(value).__name__}:{value}"


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


def compare(frame, con, sql: str) -> str | None:
    """None when both results are equal, else what differs."""
    got_columns = frame.columns
    got = _rows(got_columns, frame.collect())
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = _rows(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"row {g} != {w}"
    if not got:
        return "both empty"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from rookery import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("oracle", "local[8]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle, failed = entry.oracle_sql(), 0
    for key, query in entry.queries().items():
        if argv[1:] and key not in argv[1:]:
            continue
        started = time.perf_counter()
        try:
            problem = compare(query(spark, sf_dir), con, oracle[key])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {key} {time.perf_counter() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
