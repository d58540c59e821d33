"""Run registered queries next to their check SQL and compare the results."""

from __future__ import annotations

import decimal
import math
import os
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    return f"{type(value).__name__}:{value}"


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, run, sql):
    """None when equal, else a text that tells the difference; a query without SQL is not compared."""
    if sql is None:
        return "no check SQL"
    df = run(spark, sf_dir)
    got_columns, got = normalise(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    want_columns, want = normalise(relation.columns, relation.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        only_got = sorted(set(got) - set(want))[:3]
        only_want = sorted(set(want) - set(got))[:3]
        return f"{len(got)} rows against {len(want)}\n  spark {only_got}\n  check {only_want}"
    if not got:
        return "no rows on either side"
    return None


if __name__ == "__main__":
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from jobtide.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    if os.environ.get("PLAIN"):
        # a session without any of our settings, as somebody else may bring it
        from pyspark.sql import SparkSession

        session = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        session = local_session(8)
    connection = connect(sf)
    checks = entry.oracle_sql()
    chosen = sys.argv[1:] or list(checks)
    bad = 0
    for key in chosen:
        started = time.time()
        try:
            problem = compare(session, connection, sf, key, entry.queries()[key], checks.get(key))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {key} {time.time() - started:.2f}s", problem or "", flush=True)
    print("bad:", bad)
