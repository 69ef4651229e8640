"""Side-by-side run of the registered queries and their SQL."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, float(value))
    return (3, str(value))


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and its SQL, empty when nothing does."""
    start = time.time()
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(columns)}"]
    expected = _rows(columns, found.fetchall())
    if os.environ.get("SHOW_SQL_TIME"):
        print(f"   SQL {time.time() - start:.2f}s")
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(expected) != len(actual):
        return [f"{len(actual)} rows against {len(expected)}"]
    return [f"{a} against {e}" for a, e in zip(actual, expected) if a != e][:3]


def main() -> None:
    from shelfwatch.plans.oracles import ORACLES
    from shelfwatch.plans.queries import QUERIES
    from shelfwatch.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    print("no SQL:", sorted(set(QUERIES) - set(ORACLES)), "no query:", sorted(set(ORACLES) - set(QUERIES)))
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            wrong = differences(df, con, ORACLES[name]) if name in ORACLES else [f"no SQL, {df.count()} rows"]
        except Exception as exc:  # noqa: BLE001 - the report goes on with the next query
            wrong = [f"{type(exc).__name__}: {str(exc)[:700]}"]
        print(f"{time.time() - start:6.2f}s {name}: {'ok' if not wrong else wrong}", flush=True)


if __name__ == "__main__":
    main()
