"""Run a registered query in Spark and its SQL in DuckDB on the same files and compare."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    return repr(v)


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty when equal."""
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    want = normal(names, rel.fetchall())
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    out = []
    if sorted(names) != sorted(df.columns):
        out.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        missing = [r for r in got if r not in set(want)][:3]
        extra = [r for r in want if r not in set(got)][:3]
        out.append(f"only spark {str(missing)[:900]}\n   only sql {str(extra)[:900]}")
    return out


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    session = make_session()
    con = connect(sf)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        t0 = time.time()
        try:
            df = run(session, sf)
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                problems = [] if df.count() > 0 else ["no rows"]
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:1200]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - t0:.2f}s", flush=True)
        for p in problems:
            print("   ", p, flush=True)
    print("failed:", bad)
