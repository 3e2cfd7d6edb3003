"""Compare every query with its SQL twin: columns, types, rows.

Usage: python -m harness.check [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from harness.oracle import ORACLES
from harness.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def compare(
    spark: SparkSession, con, sf: str, name: str, queries=QUERIES, oracles=ORACLES
) -> str | None:
    """None if both sides agree, else what differs."""
    got = queries[name](spark, sf).toArrow()
    want = con.sql(oracles[name]).to_arrow_table()
    cols = sorted(got.column_names)
    if cols != sorted(want.column_names):
        return f"columns {cols} / {sorted(want.column_names)}"
    types = [
        (c, str(got.schema.field(c).type), str(want.schema.field(c).type))
        for c in cols
        if got.schema.field(c).type != want.schema.field(c).type
    ]
    if types:
        return f"types {types}"
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} / {want.num_rows}"
    listed = ", ".join(f'"{c}"' for c in cols)
    con.register("got", got)
    con.register("want", want)
    for left, right in (("got", "want"), ("want", "got")):
        extra = con.sql(
            f"SELECT {listed} FROM {left} EXCEPT ALL SELECT {listed} FROM {right} LIMIT 2"
        ).fetchall()
        if extra:
            return f"only in {left}: {extra}"
    return None


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.maxResultSize", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in names:
        start = time.time()
        try:
            diff = compare(spark, con, sf, name)
        except Exception as exc:  # report and go on with the other queries
            diff = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += diff is not None
        print(f"{name:24s} {time.time() - start:6.1f}s  {diff or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
