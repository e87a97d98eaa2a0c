"""Compare registered queries with their SQL on another engine: python tests/check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    """Rows as tuples in name order, sorted; floats must agree exactly."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, build, sql):
    started = time.time()
    df = build(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return None, f"{len(got)} rows, no SQL", took
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    a, b = canonical(df.columns, got), canonical(columns, cur.fetchall())
    if a == b:
        return True, f"{len(got)} rows", took
    if a[0] != b[0]:
        return False, f"columns {a[0]} / {b[0]}", took
    only_a = [r for r in set(a[1]) - set(b[1])][:3]
    only_b = [r for r in set(b[1]) - set(a[1])][:3]
    return False, f"{len(a[1])} / {len(b[1])} rows; {a[0]} only here {only_a}; only SQL {only_b}", took


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from dugout.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = local_session("check", 8), connect(sf_dir)
    oracles = oracle_sql()
    bad = 0
    for name, build in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        try:
            ok, text, took = compare(spark, con, sf_dir, name, build, oracles.get(name))
        except Exception as error:
            ok, text, took = False, f"{type(error).__name__}: {str(error)[:600]}", 0.0
        bad += ok is False
        print(f"{'ok  ' if ok else '--  ' if ok is None else 'FAIL'} {name} {took:.2f}s {text}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
