"""Compare a registered Spark query with its DuckDB oracle.

Columns are compared by name (sorted), types by a Spark -> DuckDB mapping,
and values as an order-insensitive multiset of normalised rows.

Command line: ``python tests/oracle_compare.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
             "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT",
             "timestamp": "TIMESTAMP WITH TIME ZONE"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def spark_type(t) -> str:
    s = t.simpleString()
    if s.startswith("decimal"):
        return s.upper().replace(" ", "")
    return _TYPE_MAP.get(s, s.upper())


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    elapsed = time.time() - t0
    s_names = df.columns
    s_types = {f.name: spark_type(f.dataType) for f in df.schema.fields}
    out = {"query": name, "spark_rows": len(s_rows), "sec": round(elapsed, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_names = rel.columns
    d_types = {n: str(t).replace(" ", "") for n, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    out["oracle_rows"] = len(d_rows)
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns {sorted(s_names)} vs {sorted(d_names)}")
    else:
        for n in s_names:
            if s_types[n].replace(" ", "") != d_types[n]:
                problems.append(f"type {n}: {s_types[n]} vs {d_types[n]}")
        if len(s_rows) != len(d_rows):
            problems.append(f"rows {len(s_rows)} vs {len(d_rows)}")
        elif _rows(s_rows, s_names) != _rows(d_rows, d_names):
            a, b = _rows(s_rows, s_names), _rows(d_rows, d_names)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    out["status"] = "ok" if not problems else "FAIL"
    if problems:
        out["problems"] = problems
    return out


def main(argv: list[str]) -> int:
    import __spark_entry__ as e
    from landfall.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as ex:  # report and go on
            r = {"query": name, "status": "ERROR", "error": repr(ex)[:400]}
        bad += r["status"] in ("FAIL", "ERROR")
        print(r, flush=True)
    print(f"{len(qs)} queries, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
