"""Runs a job and its SQL twin on the same folder and compares whole results."""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def sql_session(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def compare(df, con, text: str) -> str | None:
    """None when equal, else what differs."""
    left_cols = sorted(df.columns)
    left = sorted(tuple(plain(row[c]) for c in left_cols) for row in df.collect())
    result = con.execute(text)
    names = [d[0] for d in result.description]
    if sorted(names) != left_cols:
        return f"columns {left_cols} != {sorted(names)}"
    order = [names.index(c) for c in left_cols]
    right = sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    if len(left) != len(right):
        extra = [r for r in left if r not in set(right)][:2]
        lack = [r for r in right if r not in set(left)][:2]
        return f"rows {len(left)} != {len(right)}; only spark {extra}; only sql {lack}"
    for a, b in zip(left, right):
        if a != b:
            return f"{left_cols}: {str(a)[:600]} != {str(b)[:600]}"
    return None


def main() -> int:
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries
    from paperflow.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = sql_session(folder), 0
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = fn(spark, folder)
            text = oracle_sql().get(name)
            problem = compare(df, con, text) if text else f"(no sql) {df.count()} rows"
            state = "ok  " if problem is None else ("rows" if not text else "BAD ")
        except Exception as error:  # report and go on with the next job
            state, problem = "FAIL", f"{type(error).__name__}: {str(error)[:1500]}"
        bad += state in ("BAD ", "FAIL")
        print(f"{state} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
