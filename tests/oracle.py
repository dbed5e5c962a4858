"""Compare registered queries with their SQL in DuckDB: ``python -m tests.oracle [names]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(value):
    if value is None or value != value:
        return None
    if hasattr(value, "tzinfo"):
        return value.replace(tzinfo=None)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda t: tuple((v is None, str(type(v)), str(v)) for v in t)), [columns[i] for i in order]


def compare(spark, con, name, query, sql, folder) -> tuple[str, float, int]:
    """Empty text when both give the same rows, else the first difference."""
    start = time.time()
    frame = query(spark, folder)
    mine, columns = _sorted(frame.columns, [tuple(r) for r in frame.collect()])
    spent = time.time() - start
    if sql is None:
        return ("" if mine else "no rows"), spent, len(mine)
    result = con.execute(sql)
    theirs, names = _sorted([c[0] for c in result.description], result.fetchall())
    if columns != names:
        return f"columns {columns} != {names}", spent, len(mine)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}", spent, len(mine)
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a}\n   != {b}", spent, len(mine)
    kinds = [{type(v) for v in col if v is not None} for col in zip(*mine)] if mine else []
    other = [{type(v) for v in col if v is not None} for col in zip(*theirs)] if theirs else []
    if kinds != other:
        return f"types {kinds} != {other}", spent, len(mine)
    return "", spent, len(mine)


def main(names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from gridlark.session import local_session

    folder = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.01")
    spark, con = local_session(), connect(folder)
    sqls, bad = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        try:
            problem, spent, rows = compare(spark, con, name, query, sqls.get(name), folder)
        except Exception as error:  # report and go on
            problem, spent, rows = f"{type(error).__name__}: {str(error)[:600]}", 0.0, 0
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '}{name:32s} {spent:6.2f}s {rows:7d} {'sql' if name in sqls else 'rows'} {problem}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
