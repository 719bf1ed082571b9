"""Run catalogued queries next to their SQL twins: ``python tests/compare.py [sf] [name ...]``."""
from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "<null>" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool):
        return str(v)
    return str(v)


def canonical(columns, rows):
    idx = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in idx], sorted(tuple(_cell(r[i]) for i in idx) for r in rows)


def compare(spark, con, folder, fn, sql):
    df = fn(spark, folder)
    got_cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, f"{len(got)} rows, no SQL"
    rel = con.execute(sql)
    cols = [c[0] for c in rel.description]
    kinds = [str(c[1]) for c in rel.description]
    want_cols, want = canonical(cols, rel.fetchall())
    odd = [f"{c}:{k}" for c, k in zip(cols, kinds) if "DECIMAL" in k or "HUGEINT" in k]
    if odd:
        return False, f"types {odd}"
    if got_cols != want_cols:
        return False, f"columns {got_cols} / {want_cols}"
    if got != want:
        a, b = [x for x in got if x not in set(want)][:2], [x for x in want if x not in set(got)][:2]
        return False, f"rows {len(got)}/{len(want)} got {a} want {b}"
    return True, f"{len(got)} rows"


def main():
    from tabulon.catalog import ENTRIES
    from tabulon.session import local_session
    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), duck(folder)
    bad = 0
    for name, (fn, sql) in ENTRIES.items():
        if len(args) > 1 and name not in args[1:]:
            continue
        t = time.time()
        try:
            ok, note = compare(spark, con, folder, fn, sql)
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += ok is False
        word = "ok  " if ok else "rows" if ok is None else "FAIL"
        print(f"{word} {name} {time.time() - t:.1f}s {note if not ok else note}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
