"""Runs queries next to their SQL in DuckDB and compares all rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs first."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected, actual = _rows(names, cur.fetchall()), _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e or [type(x) for x in a] != [type(x) for x in e]:
            return f"{a} != {e}"
    return None


def main() -> None:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from parley.session import build_session

    sf_dir = sys.argv[1]
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracle:
                verdict = difference(df, con, oracle[name]) or "ok"
            else:
                verdict = f"rows only: {df.count()}"
        except Exception as e:
            verdict = f"ERROR {type(e).__name__}: {str(e)[:400]}"
        print(f"{name:32s} {time.time() - began:6.2f}s  {verdict[:600]}", flush=True)


if __name__ == "__main__":
    main()
