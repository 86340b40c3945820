"""Run a query on Spark and its SQL on DuckDB and compare the results value by value.

As a script: ``python tests/oracle.py <sf> [query ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
DATA = "/root/testdata"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[int, list[str]]:
    """Row count and a list of what differs (empty when equal)."""
    df = query(spark, sf_dir)
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    faults = []
    if sorted(df.columns) != sorted(names):
        return len(got), [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(got) != len(want):
        faults.append(f"rows {len(got)} != {len(want)}")
    a, b = _rows(df.columns, got), _rows(names, want)
    off = [(x, y) for x, y in zip(a, b) if x != y]
    if off:
        faults.append(f"{len(off)} rows differ, first {off[0]}")
    return len(got), faults


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("spanfolio")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from spanfolio.plans import registry

    sf_dir = f"{DATA}/sf{sys.argv[1]}"
    spark = session()
    con = connect(sf_dir)
    queries, oracles = registry.queries(), registry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or list(queries):
        began = time.time()
        try:
            if name in oracles:
                n, faults = compare(spark, con, queries[name], oracles[name], sf_dir)
            else:
                n, faults = queries[name](spark, sf_dir).count(), []
        except Exception as e:  # noqa: BLE001
            n, faults = -1, [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(faults)
        mark = "FAIL" if faults else ("ok" if name in oracles else "rows")
        print(f"{mark:5}{name:32}{n:8}{time.time() - began:8.2f}s {' | '.join(faults)}", flush=True)
    print("failed:", bad)
    spark.stop()
