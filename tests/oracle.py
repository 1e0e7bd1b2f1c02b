"""Runs registered queries beside their SQL on the same files and compares them.

    python -m tests.oracle [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("null", None) if math.isnan(value) else ("float", repr(value + 0.0))
    if isinstance(value, dt.datetime):
        return ("timestamp", value.isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    return ("null", None) if value is None else (type(value).__name__, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def compare(df, con, sql: str) -> str:
    """'' if equal, else what differs."""
    rel = con.execute(sql)
    want_columns = [d[0] for d in rel.description]
    want = rows_of(want_columns, rel.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g.\n    {bad[0][0]}\n    {bad[0][1]}"
    return "" if got else "no rows on either side"


def main() -> None:
    from tallyhouse.config import session
    from tallyhouse.plans import QUERIES, SQL

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--dir")
    args = parser.parse_args()
    sf_dir = args.dir or f"/root/testdata/sf{args.sf}"
    spark, con = session("oracle", 8), connect(sf_dir)
    failed = []
    picked = [n for n in QUERIES if not args.names or any(a in n for a in args.names)]
    for name in picked:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = (compare(df, con, SQL[name]) if name in SQL
                       else f"rows only: {len(df.collect())}")
        except Exception as e:  # report and go on to the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        spark.catalog.clearCache()
        ok = problem == "" or problem.startswith("rows only")
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {problem}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(picked) - len(failed)} of {len(picked)} ok; failed: {failed}")


if __name__ == "__main__":
    main()
