"""Run queries and their SQL counterparts side by side: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def _key(row):
    return tuple((v is not None, str(type(v)), str(v)) for v in row)


def table(columns, rows):
    """Column names sorted, rows in that column order, sorted."""
    index = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return [columns[i].lower() for i in index], sorted(
        (tuple(_cell(r[i]) for i in index) for r in rows), key=_key
    )


def differences(df, con, sql: str) -> list[str]:
    names, rows = table(df.columns, df.collect())
    result = con.execute(sql)
    expected_names, expected = table([d[0] for d in result.description], result.fetchall())
    if names != expected_names:
        return [f"columns {names} instead of {expected_names}"]
    found = [] if len(rows) == len(expected) else [f"{len(rows)} rows instead of {len(expected)}"]
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    found += [f"{len(wrong)} rows differ"] * bool(wrong) + [f"  got {a}\n  not {b}" for a, b in wrong[:2]]
    types = {(n, type(x).__name__, type(y).__name__) for a, b in zip(rows[:500], expected[:500])
             for n, x, y in zip(names, a, b) if x is not None and y is not None and type(x) is not type(y)}
    return found + [f"type {t}" for t in sorted(types)]


if __name__ == "__main__":
    import __spark_entry__ as entry
    from starwash.session import build_session

    base = tempfile.mkdtemp(prefix="compare-")
    spark = build_session("compare", "local[8]", 8, **{
        "spark.driver.memory": "8g", "spark.checkpoint.dir": f"{base}/shared", "spark.sql.warehouse.dir": f"{base}/warehouse",
    })
    spark.sparkContext.setLogLevel("ERROR")
    sf, chosen = sys.argv[1], sys.argv[2:]
    queries, oracle, con = entry.queries(), entry.oracle_sql(), connect(sf)
    bad = 0
    for name in chosen or queries:
        t = time.time()
        try:
            found = differences(queries[name](spark, sf), con, oracle[name])
        except Exception as e:  # report and go on
            found = [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name} {time.time() - t:.1f}s", *found, sep="\n     " if found else "", flush=True)
    print(f"{bad} of {len(chosen or queries)} differ")
