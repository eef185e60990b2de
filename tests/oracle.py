"""Run registered queries next to their SQL in DuckDB and compare whole results.

    python -m tests.oracle [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SF = "/root/testdata/sf0.01"


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, folder: str) -> tuple[bool, str]:
    import __spark_entry__ as entry

    started = time.time()
    df = entry.queries()[name](spark, folder)
    rows = df.collect()
    took = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"rows only: {len(rows)} rows, {took:.1f}s"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} expected {sorted(columns)}"
    ours, theirs = _bag(df.columns, rows), _bag(columns, expected)
    types = {c: t for c, t in df.dtypes}
    kinds = {d[0]: str(d[1]) for d in result.description}
    if ours == theirs:
        pairs = " ".join(f"{c}:{types[c]}/{kinds[c]}" for c in sorted(columns))
        return True, f"{len(rows)} rows, {took:.1f}s  [{pairs}]"
    extra = list((ours - theirs).elements())[:2]
    missing = list((theirs - ours).elements())[:2]
    return False, f"{len(rows)} rows, {len(expected)} expected\n  extra   {str(extra)[:700]}\n  missing {str(missing)[:700]}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default=SF)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    import __spark_entry__ as entry
    from millrace.session import local_session

    spark = local_session()
    con = oracle_connection(args.sf)
    failed = 0
    for name in args.names or list(entry.queries()):
        try:
            good, note = compare(spark, con, name, args.sf)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not good
        print("ok  " if good else "FAIL", name, note, flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
