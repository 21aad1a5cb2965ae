"""Compare registered queries with their SQL on one directory: python tests/check.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr), sorted(columns)


def compare(spark, con, sf, name, query, sql):
    """None when both sides agree, otherwise a short description of the first difference."""
    df = query(spark, sf)
    got, got_cols = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want, want_cols = rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; {[x for x in got if x not in want][:1]} {[x for x in want if x not in got][:1]}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a!r} != {b!r}"
    return None


def main():
    from conftest import make_session
    import __spark_entry__ as entry
    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con, bad = make_session(), connect(sf), 0
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if args and name not in args:
            continue
        t = time.time()
        try:
            diff = compare(spark, con, sf, name, query, sqls[name]) if name in sqls else f"no sql, {query(spark, sf).count()} rows"
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} {time.time() - t:.1f}s {(diff or '')[:900]}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
