"""Run named queries and their SQL side by side.

``python -m tests.compare <sf_dir> [names]`` checks all of them or the given ones.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from reportloom.sources.adapters import BASE_TABLES  # noqa: E402

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _value(v):
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


def compare(spark, sf_dir: str, name: str) -> str | None:
    """None when rows, column names and types agree, else what differs."""
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = entry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(tuple(_value(r[c]) for c in cols) for r in df.collect())
    found = con.execute(entry.oracle_sql()[name])
    sql_types = {c[0]: str(c[1]) for c in found.description}
    at = [[c[0] for c in found.description].index(c) for c in cols] if sorted(sql_types) == cols else None
    if at is None:
        return f"columns {cols} and {sorted(sql_types)}"
    want = sorted(tuple(_value(r[i]) for i in at) for r in found.fetchall())
    types = {c: (t, sql_types[c]) for c, t in df.dtypes if TYPES.get(t) != sql_types[c]}
    if types:
        return f"types {types}"
    if got != want:
        return f"{len(got)} and {len(want)} rows, e.g. {sorted(set(got) - set(want))[:2]} and {sorted(set(want) - set(got))[:2]}"
    return None


if __name__ == "__main__":
    from reportloom.session import build_session

    session = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    session.sparkContext.setLogLevel("OFF")
    bad = 0
    for query in sys.argv[2:] or entry.queries():
        began = time.time()
        problem = compare(session, sys.argv[1], query) if query in entry.oracle_sql() else "no SQL"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {query} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)
