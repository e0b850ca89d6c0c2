"""Compare each registered query with its SQL oracle.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    return value


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp", "BOOLEAN": "boolean",
}


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides have the same columns, types and rows."""
    cursor = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    their_rows = cursor.fetchall()
    ours = dict(df.dtypes)
    names = sorted(ours)
    if names != sorted(theirs):
        return [f"columns {names} != {sorted(theirs)}"]
    found = [
        f"type of {n}: {ours[n]} != {theirs[n]}"
        for n in names
        if KINDS.get(theirs[n], theirs[n]) != ours[n].removesuffix("_ntz")
    ]
    position = {n: i for i, n in enumerate(theirs)}
    a = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    b = sorted((tuple(plain(r[position[n]]) for n in names) for r in their_rows), key=repr)
    if len(a) != len(b):
        found.append(f"rows {len(a)} != {len(b)}")
    elif a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        found.append(f"{len(bad)} of {len(a)} rows differ, first {bad[0]}")
    return found


def main() -> int:
    sys.path.insert(0, ROOT)
    import __spark_entry__ as entry
    from tulha.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    con = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            found = differences(df, con, oracle[name]) if name in oracle else [f"no oracle, {df.count()} rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found) and name in oracle
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - start:.1f}s", *found, flush=True)
    print("failed:", failed, "missing queries:", sorted(set(oracle) - set(queries)))
    return failed


if __name__ == "__main__":
    sys.exit(main())
