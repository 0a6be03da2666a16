"""Run every catalogue query in Spark and its SQL twin in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]

Comparison: same column names, same row count and the same multiset of
rows (values compared exactly, after sorting rows).  Prints one line per
query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(float(v)))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    return (3, str(v))


# Spark simpleString -> DuckDB type name of the same logical type.
TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}


def type_mismatches(df, rel) -> list[str]:
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [f"{c}: {spark_types[c]} vs {duck_types.get(c)}" for c in spark_types
            if TYPE_MAP.get(spark_types[c], spark_types[c]) != duck_types.get(c)]


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out)


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, str]:
    import __spark_entry__ as entry

    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # report and go on with the next query
            results[name] = f"SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}"
            continue
        dt = time.time() - t0
        if name not in sql:
            results[name] = f"rows-only ({len(s_rows)} rows, {dt:.2f}s)"
            continue
        try:
            rel = con.sql(sql[name])
            d_cols = [c for c in rel.columns]
            d_rows = rel.fetchall()
        except Exception as exc:
            results[name] = f"SQL ERROR {type(exc).__name__}: {str(exc)[:300]}"
            continue
        if sorted(s_cols) != sorted(d_cols):
            results[name] = f"SCHEMA MISMATCH spark={s_cols} sql={d_cols}"
            continue
        bad_types = type_mismatches(df, rel)
        if bad_types:
            results[name] = f"TYPE MISMATCH {bad_types}"
            continue
        a, b = rows_of(s_rows, s_cols), rows_of(d_rows, d_cols)
        if len(a) != len(b):
            results[name] = f"ROWCOUNT MISMATCH spark={len(a)} sql={len(b)}"
        elif a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            results[name] = f"VALUE MISMATCH ({sum(x != y for x, y in zip(a, b))} rows) e.g. {diff}"
        else:
            results[name] = f"ok ({len(a)} rows, {dt:.2f}s)"
    return results


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    from tracelens.session import build_session

    spark = build_session("local[8]", 8)
    res = compare(spark, sf_dir, names)
    bad = 0
    for k, v in res.items():
        print(f"{k:28s} {v}")
        bad += not (v.startswith("ok") or v.startswith("rows-only"))
    print(f"{len(res) - bad}/{len(res)} pass")
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
