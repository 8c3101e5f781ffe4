"""Run registered queries beside their SQL and compare whole results."""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    if isinstance(value, list):
        return tuple(_norm(v) for v in value)
    return value


def _key(row):
    return tuple((v is not None, str(type(v).__name__), v if v is not None else 0) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(shaped, key=_key)


# Spark and DuckDB names of the types used.
SAME_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def compare(con, query, sql, spark, sf_dir):
    """Empty text when equal, else what differs."""

    df = query(spark, sf_dir)
    shown = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    odd = [(c, t, shown.get(c)) for c, t in df.dtypes if SAME_TYPES.get(t) != shown.get(c)]
    if odd:
        return f"types {odd}"
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; e.g. {got[:2]} / {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ of {len(got)}: {bad[:2]}" if bad else ""


def main(sf_dir: str, names: list[str]) -> int:
    import os
    import tempfile

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from sonoledger.session import build_session

    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = build_session(
        master="local[8]", shuffle_partitions=8,
        extra={"spark.ui.enabled": "false", "spark.checkpoint.dir": f"{scratch}/shared",
               "spark.sql.warehouse.dir": f"{scratch}/wh", "spark.driver.memory": "6g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    queries, sqls = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        began = time.time()
        try:
            if name in sqls:
                diff = compare(con, queries[name], sqls[name], spark, sf_dir)
            else:
                diff = "" if queries[name](spark, sf_dir).count() >= 0 else "?"
        except Exception as exc:
            diff = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += bool(diff)
        mark = "ok " if not diff else "BAD"
        print(f"{mark} {name} {time.time() - began:.2f}s {'' if name in sqls else '(rows only)'} {diff}",
              flush=True)
    spark.stop()
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
