"""Run registered queries against DuckDB on the same tables: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import pathlib
import sys
import time
from decimal import Decimal

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in at) for r in rows), key=repr)


def compare(spark, con, sf_dir, name, fn, sql) -> str | None:
    """None when equal, else what differs."""
    got = fn(spark, sf_dir)
    mine = rows_of(got.columns, [tuple(r) for r in got.collect()])
    if sql is None:
        return None if mine else "no rows"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(columns)}"
    if mine == want:
        return None
    have, need = set(mine), set(want)
    extra, missing = [r for r in mine if r not in need][:2], [r for r in want if r not in have][:2]
    return f"{len(mine)} rows, wanted {len(want)} ({sorted(columns)}):\n   spark  {extra}\n   duckdb {missing}"


def main() -> int:
    from tests.conftest import make_session
    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = make_session(), connect(sf_dir)
    oracle, names, bad = oracle_sql(), sys.argv[2:], 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            diff = compare(spark, con, sf_dir, name, fn, oracle.get(name))
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        kind = "oracle" if name in oracle else "rows"
        print(f"{'FAIL' if diff else 'ok  '} {name:28s} {kind:6s} {time.time() - start:6.2f}s {diff or ''}", flush=True)
        bad += bool(diff)
    print("failures:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
