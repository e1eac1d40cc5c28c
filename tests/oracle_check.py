"""Run registered Spark queries and their DuckDB oracle side by side.

Compares row count, column names and an order-insensitive hash of the
values (columns sorted by name), the way the correctness gate does.

    python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "\0NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if isinstance(v, bool):
        return str(v)
    return str(v)


def value_hash(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    spark_s = time.time() - t0
    out = {"name": name, "rows": len(s_rows), "spark_s": round(spark_s, 2)}
    if sql is None:
        out["match"] = None
        return out
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = [tuple(r) for r in res.fetchall()]
    out["oracle_rows"] = len(d_rows)
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    out["hash_match"] = value_hash(s_cols, s_rows) == value_hash(d_cols, d_rows)
    out["match"] = out["cols_match"] and out["hash_match"] and len(s_rows) == len(d_rows)
    if not out["match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["spark_sample"], out["oracle_sample"] = sorted(map(str, s_rows))[:5], sorted(map(str, d_rows))[:5]
    return out


def main(argv: list[str]) -> int:
    from crashlens.session import build_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    filters = argv[1:]
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if filters and not any(f in name for f in filters):
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as err:  # report and go on
            r = {"name": name, "match": False, "error": repr(err)[:500]}
        bad += r.get("match") is False
        print(r, flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
