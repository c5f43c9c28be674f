"""Compare registered queries with their SQL: names, row count and every value."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return None if v is None else f"{type(v).__name__}:{v}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(_value(r[i])) for i in order) for r in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    expected = want.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, got), _rows(names, expected)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ ({sorted(names)}), first: {bad[0]}"
    return None if a else "no rows"


def main(sf_dir: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from sparkmart.session import local_session

    spark, con, oracles, failed = local_session(8, work=tempfile.mkdtemp(prefix="compare-")), connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, query, oracles[name], sf_dir)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
