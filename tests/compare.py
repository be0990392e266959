"""Run registered queries in Spark and their SQL in DuckDB and compare whole results.

    python -m tests.compare [sf folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value if value is None or isinstance(value, bool) else str(value)


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, db, sf_dir: str, run, sql: str) -> tuple[str, int, str]:
    """``ok`` or what differs, the number of rows, and the Spark types for a report."""
    start = time.time()
    df = run(spark, sf_dir)
    rows = df.collect()
    spent = time.time() - start
    start = time.time()
    cursor = db.execute(sql)
    names, expected = [d[0] for d in cursor.description], cursor.fetchall()
    timing = f"spark {spent:.1f}s duckdb {time.time() - start:.1f}s"
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(rows), timing
    left, right = multiset(df.columns, rows), multiset(names, expected)
    if left != right:
        only_left, only_right = left - right, right - left
        sample = f"\n  spark  {list(only_left)[:2]}\n  duckdb {list(only_right)[:2]}"
        return f"{sum(only_left.values())}/{sum(only_right.values())} rows differ{sample}", len(rows), timing
    kinds = {
        f.name: (f.dataType.simpleString(), dict((d[0], str(d[1])) for d in cursor.description)[f.name])
        for f in df.schema
    }
    same = {("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("string", "VARCHAR"), ("boolean", "BOOLEAN")}
    odd = {name: pair for name, pair in kinds.items() if pair not in same}
    return ("ok" if not odd else f"ok, types {odd}"), len(rows), timing


def main() -> None:
    import __spark_entry__ as entry
    from ticketlake.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, db = local_session(8), connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        try:
            if name in oracle:
                print(name, *compare(spark, db, sf_dir, queries[name], oracle[name]), flush=True)
            else:
                print(name, "no sql,", queries[name](spark, sf_dir).count(), "rows", flush=True)
        except Exception as error:  # a report: go on with the next query
            print(name, "ERROR", str(error)[:1500], flush=True)


if __name__ == "__main__":
    main()
