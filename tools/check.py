"""Run acceptance queries and compare each with its SQL twin in DuckDB.

    python tools/check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from emberscope.acceptance import REGISTRY
from emberscope.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return str(v) if v is not None else "\0null"

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


SAME_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date",
}


def compare(name: str, spark, con, sf_dir: str) -> tuple[bool, str, float]:
    q = REGISTRY[name]
    began = time.time()
    df = q(spark, sf_dir)
    got = df.collect()
    took = time.time() - began
    if q.sql is None:
        return True, f"{len(got)} rows (no twin)", took
    cur = con.execute(q.sql)
    cols = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(cols) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(cols)}", took
    odd = [
        f"{c}: {t} vs {types[c]}" for c, t in df.dtypes if SAME_TYPES.get(types[c], types[c]) != t
    ]
    if odd:
        return False, f"types {odd}", took
    a, b = canonical(df.columns, got), canonical(cols, want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return False, f"{len(a)} vs {len(b)} rows; spark only {only_a}; twin only {only_b}", took
    return True, f"{len(a)} rows" + (" EMPTY" if not a else ""), took


def main() -> int:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("names", nargs="*")
    args = p.parse_args()
    spark, con = local_session(8), connect(args.sf)
    bad = []
    for name in args.names or REGISTRY:
        try:
            ok, note, took = compare(name, spark, con, args.sf)
        except Exception as e:
            ok, note, took = False, f"{type(e).__name__}: {str(e)[:900]}", 0.0
        print(f"{'ok  ' if ok else 'FAIL'} {name} {took:.2f}s {note}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} failed: {' '.join(bad)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
