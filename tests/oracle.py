"""Local twin of the driver's correctness check: Spark query vs DuckDB SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import math
import sys

import duckdb

RAW_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "\x00NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sn, sr = rows_of(s_cols, s_rows)
    dn, dr = rows_of(d_cols, d_rows)
    if sn != dn:
        return False, f"columns differ: spark={sn} duck={dn}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    if sr != dr:
        only_s = [r for r in sr if r not in set(dr)][:3]
        only_d = [r for r in dr if r not in set(sr)][:3]
        return False, f"values differ ({len(sr)} rows); spark-only {only_s}; duck-only {only_d}"
    return True, f"{len(sr)} rows"


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from poolwright.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    plain = "--plain" in argv
    argv = [a for a in argv if a != "--plain"]
    names = [a for a in argv if not a.startswith("/")] or list(E.queries())
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
    if plain:
        # a session with Spark's defaults (as a caller would have), UI off
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names:
        try:
            df = qs[name](spark, sf_dir)
            if name not in sqls:
                print(f"{name:34s} rows-only {df.count()}")
                continue
            ok, msg = compare(df, sqls[name], con)
        except Exception as exc:  # report and keep going
            ok, msg = False, f"ERROR {type(exc).__name__}: {str(exc)[:300]}"
        bad += not ok
        print(f"{name:34s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
