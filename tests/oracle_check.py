"""Run registered queries beside their SQL oracle: python tests/oracle_check.py [sf] [name...]."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as spark_entry  # noqa: E402


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def as_bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_cell(row[i]) for i in order) for row in rows
    )


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    start = time.time()
    frame = spark_entry.queries()[name](spark, sf_dir)
    rows = frame.collect()
    took = time.time() - start
    columns, bag = as_bag(frame.columns, rows)
    result = con.execute(spark_entry.oracle_sql()[name])
    oracle_columns, oracle_bag = as_bag([d[0] for d in result.description], result.fetchall())
    same = columns == oracle_columns and bag == oracle_bag
    detail = f"{len(rows)} rows, {sum(oracle_bag.values())} expected, {took:.2f} s"
    if not same:
        detail += f"\n  {columns}\n  {oracle_columns}"
        detail += f"\n  extra {list((bag - oracle_bag).items())[:3]}"
        detail += f"\n  missing {list((oracle_bag - bag).items())[:3]}"
    return same, detail


if __name__ == "__main__":
    from conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    directory = f"/root/testdata/sf{sf}"
    session, connection = make_session(), oracle_connection(directory)
    for query in sys.argv[2:] or spark_entry.oracle_sql():
        ok, detail = compare(session, connection, directory, query)
        print("ok  " if ok else "FAIL", query, detail, flush=True)
