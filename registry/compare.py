"""Run registered queries beside their check SQL and compare names, types and values.

    python -m registry.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KINDS = {"string": "text", "varchar": "text", "bigint": "int", "double": "double", "boolean": "bool"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(rows, order):
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """'ok' or what differs."""
    kinds = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    names = sorted(kinds)
    got = _rows(df.collect(), [df.columns.index(n) for n in names])
    res = con.execute(sql)
    want_kinds = {d[0]: KINDS.get(str(d[1]).lower(), str(d[1])) for d in res.description}
    order = [d[0] for d in res.description]
    if sorted(order) != names:
        return f"columns differ: {names} / {sorted(order)}"
    want = _rows(res.fetchall(), [order.index(n) for n in names])
    if kinds != want_kinds:
        return "types differ: " + str({n: (kinds[n], want_kinds[n]) for n in names if kinds[n] != want_kinds[n]})
    if len(got) != len(want):
        return f"rows differ: {len(got)} / {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    return "ok" if not bad else f"{len(bad)} values differ, first: {dict(zip(names, bad[0][0]))} / {bad[0][1]}"


def main() -> int:
    from clickloom.session import local_session
    from registry.oracle import oracle_sql
    from registry.queries import queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, sql = local_session(8), connect(sf_dir), oracle_sql()
    failed = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            verdict = compare(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as err:  # report and go on with the other queries
            verdict = "ERROR " + str(err)[:600]
        if verdict != "ok" and not verdict.startswith("rows only"):
            failed += 1
        print(f"{name:45s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
