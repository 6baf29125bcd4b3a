"""Side by side runs of registered queries in Spark and DuckDB."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def as_sorted(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(df, sql: str, sf_dir: str) -> str | None:
    """None if the results agree, else what differs."""
    names, rows = oracle_rows(sql, sf_dir)
    if sorted(names) != sorted(df.columns):
        return f"columns: {sorted(set(names) ^ set(df.columns))}"
    got, want = as_sorted(df.columns, [tuple(r) for r in df.collect()]), as_sorted(names, rows)
    if got == want:
        return None
    extra, lacking = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"rows {sum(got.values())} / {sum(want.values())}: {extra} <> {lacking}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from vitalspan.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(**{"spark.sql.shuffle.partitions": "8", "spark.master": "local[8]",
                             "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    oracle = entry.oracle_sql()
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        begin = time.time()
        try:
            result = difference(run(spark, sf), oracle[name], sf) if name in oracle else "no oracle"
        except Exception as error:  # noqa: BLE001
            result = "ERROR " + str(error)[:600]
        print(f"{name:28s} {time.time() - begin:6.2f}s  {result or 'ok'}", flush=True)
