"""Compare every registered query with its SQL counterpart: ``python tests/compare.py [sf] [names...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(spark, con, name, query, sql, sf) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf)
    got_cols, got = rows_of(df.columns, df.collect())
    if sql is None:
        return None
    result = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        g, w = set(got) - set(want), set(want) - set(got)
        return f"rows {len(got)} != {len(want)}; only spark {sorted(g, key=repr)[:2]}; only sql {sorted(w, key=repr)[:2]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tidegate.runtime import build_session

    sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.001'}"
    spark = build_session(
        master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                              "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf), entry.oracle_sql(), 0
    names = sys.argv[2:] or list(entry.queries())
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, name, entry.queries()[name], oracles.get(name), sf)
        except Exception as error:  # report and go on with the others
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name}: {'ok' if problem is None else problem} ({time.time() - start:.1f}s)", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
