"""Runs registered queries beside their oracle SQL.

    python -m tests.compare [--sf 0.01] [--runs 1] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time
import traceback
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, builder, sql: str | None) -> str:
    """Empty text if equal, else what differs."""
    df = builder(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if got else "no rows"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if a == b:
        return "" if got else "equal but empty"
    only_a, only_b = a - b, b - a
    return (
        f"rows {len(got)} vs {len(want)}; only spark {sum(only_a.values())}, only oracle "
        f"{sum(only_b.values())}\n   columns {sorted(names)}\n   spark  {sorted(only_a, key=str)[:3]}"
        f"\n   oracle {sorted(only_b, key=str)[:3]}"
    )


def main() -> None:
    import __spark_entry__ as entry
    from sensorgrid.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--runs", type=int, default=1)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = local_session("compare", 8), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        for _ in range(args.runs):
            start = time.time()
            try:
                diff = compare(spark, con, sf_dir, queries[name], oracles.get(name))
            except Exception as error:  # noqa: BLE001
                diff = "".join(traceback.format_exception_only(error))[:1500]
            kind = "O" if name in oracles else "-"
            print(f"{'ok ' if not diff else 'BAD'} {kind} {name} {time.time() - start:.1f}s {diff}", flush=True)
            bad += bool(diff)
    print(f"{bad} bad")
    spark.stop()


if __name__ == "__main__":
    main()
