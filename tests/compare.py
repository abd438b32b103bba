"""Run registered queries and their SQL side by side: python tests/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, run, sql: str, sf: str) -> tuple[bool, str]:
    """(equal, note): column names, row count and every value."""
    df = run(spark, sf)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql.replace("/root/testdata/sf0.01", sf))
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return False, f"rows {len(mine)} / {len(theirs)}"
    types = {n: str(d) for n, d in zip(names, [d[1] for d in cur.description])}
    odd = [
        (f.name, f.dataType.simpleString(), types[f.name])
        for f in df.schema.fields
        if (f.dataType.simpleString(), types[f.name])
        not in {("bigint", "BIGINT"), ("string", "VARCHAR"), ("double", "DOUBLE"), ("int", "INTEGER"), ("boolean", "BOOLEAN")}
    ]
    if mine != theirs:
        pair = next((a, b) for a, b in zip(mine, theirs) if a != b)
        return False, f"{str(pair[0])[:700]}\n  / {str(pair[1])[:700]}"
    return True, f"{len(mine)} rows" + (f" types {odd}" if odd else "")


if __name__ == "__main__":
    import __spark_entry__ as entry
    from docloom.session import build

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    spark = build(master="local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
                  spark_driver_memory="12g", spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    con, oracle, bad = connect(sf), entry.oracle_sql(), []
    for name in chosen:
        start = time.time()
        try:
            if name in oracle:
                ok, note = compare(spark, con, entry.queries()[name], oracle[name], sf)
            else:
                ok, note = True, f"{len(entry.queries()[name](spark, sf).collect())} rows, no SQL"
        except Exception as e:
            ok, note = False, f"{type(e).__name__}: {str(e)[:1200]}"
        print("ok  " if ok else "FAIL", f"{time.time() - start:6.2f}", name, note, flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)
