"""Runs every query beside its oracle: ``python tests/check.py SF_DIR [NAME...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

#: DuckDB type names for the Spark types that results may have.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None where both agree, else what differs."""
    rel = con.sql(sql)
    want_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    got_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    if got_types != want_types:
        return f"schema {got_types} / {want_types}"
    want = rows_of(rel.fetchall(), rel.columns)
    got = rows_of([tuple(r) for r in df.collect()], df.columns)
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"row {a} / {b}"
    return None if want else "both empty"


def main() -> int:
    import __spark_entry__ as e
    from tidemark.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="12g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if names and name not in names:
            continue
        began = time.monotonic()
        try:
            df = fn(spark, sf_dir)
            wrong = compare(df, con, oracles[name]) if name in oracles else \
                (None if df.count() else "no rows")
        except Exception as err:  # noqa: BLE001
            wrong = f"{type(err).__name__}: {str(err)[:700]}"
        bad += wrong is not None
        mark = "ok  " if wrong is None else "FAIL"
        print(f"{mark} {name} {time.monotonic() - began:.2f}s {wrong or ''}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
