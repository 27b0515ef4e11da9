"""Run registered queries against their SQL on DuckDB and report differences.

Usage: python -m tests.compare [sf] [name part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DATA = "/root/testdata"


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    return v


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(df, con, sql: str) -> str | None:
    """None if rows and columns agree, otherwise the first difference."""
    mine = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = _sorted([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}: {mine[1][:3]} / {theirs[1][:3]}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine[1])} rows differ, first {bad[0]}"
    kinds = [{type(v) for row in t[1] for v in row} - {type(None)} for t in (mine, theirs)]
    return None if kinds[0] == kinds[1] else f"kinds {kinds}"


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from auditlens.session import local_session

    sf, parts = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"{DATA}/sf{sf}"
    spark, con = local_session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not parts or any(p in n for p in parts)]
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                result = difference(df, con, oracles[name])
            else:
                n = df.count()
                result = None if n else "no rows"
        except Exception as e:  # report and go on with the next query
            result = f"{type(e).__name__}: {str(e)[:1500]}"
        state = "ok" if result is None else "FAIL"
        failed += result is not None
        print(f"{state:5}{time.time() - start:7.2f}s  {'sql ' if name in oracles else 'rows'} {name} {result or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
