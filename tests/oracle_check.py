"""Compare registered queries with their SQL on DuckDB.

Usage: python tests/oracle_check.py [sf] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or value != value:
        return None
    return bool(value) if isinstance(value, bool) else value


def rows_of(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(t[i]) for i in order) for t in tuples]
    return sorted(columns), sorted(rows, key=repr)


def compare(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    from driftspark.plans.catalog import QUERIES
    from driftspark.plans.oracle import ORACLE

    frame = QUERIES[name](spark, sf_dir)
    mine = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(ORACLE[name])
    theirs = rows_of([c[0] for c in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if not mine[1]:
        return "no rows"
    if mine[1] != theirs[1]:
        a, b = set(map(repr, mine[1])), set(map(repr, theirs[1]))
        return (
            f"{len(mine[1])} / {len(theirs[1])} rows; only here {sorted(a - b)[:2]}; "
            f"only in SQL {sorted(b - a)[:2]}"
        )
    return None


if __name__ == "__main__":
    from driftspark.plans.catalog import QUERIES
    from driftspark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    directory = f"/root/testdata/sf{sf}"
    session, db = local_session(), duck(directory)
    session.sparkContext.setLogLevel("ERROR")
    failed = 0
    for query in sys.argv[2:] or QUERIES:
        started = time.time()
        try:
            problem = compare(session, db, query, directory)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{query}: {'ok' if problem is None else problem[:1200]} ({time.time() - started:.1f} s)", flush=True)
    print(f"{failed} failed")
