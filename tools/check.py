"""Run registered queries next to their SQL and compare the rows.

usage: python tools/check.py SF_DIR [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from recensio import catalog  # noqa: E402
from recensio.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, name):
    started = time.time()
    df = catalog.queries()[name](spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return "rows", len(got), took, 0.0, ""
    started = time.time()
    relation = con.sql(sql)
    want = normal(relation.columns, relation.fetchall())
    sql_took = time.time() - started
    if sorted(df.columns) != sorted(relation.columns):
        return "COLUMNS", len(got), took, sql_took, f"{df.columns} / {relation.columns}"
    if got != want:
        extra = [g for g in got if g not in set(want)][:2]
        missing = [w for w in want if w not in set(got)][:2]
        return "DIFF", len(got), took, sql_took, f"{len(want)} wanted; got {str(extra)[:600]} want {str(missing)[:600]}"
    return "ok", len(got), took, sql_took, ""


def main() -> None:
    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in catalog.queries():
        if prefixes and not name.startswith(prefixes):
            continue
        try:
            state, rows, took, sql_took, note = compare(spark, con, sf_dir, name)
        except Exception as error:
            state, rows, took, sql_took, note = "ERROR", 0, 0.0, 0.0, str(error)[:1500]
        bad += state not in ("ok", "rows")
        print(f"{state:8}{name:36}{rows:8d} rows {took:7.2f}s spark {sql_took:7.2f}s sql {note}", flush=True)
    print("not equal:", bad)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
