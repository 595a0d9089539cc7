"""Run registered queries and their SQL side by side.

    python tools/check_oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "string": "varchar", "int": "integer", "timestamp_ntz": "timestamp", "array<string>": "varchar[]",
    "array<bigint>": "bigint[]", "array<double>": "double[]",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([_plain(row[i]) for i in order]) for row in rows)


def compare(spark, con, run, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    df = run(spark, sf_dir)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    types = {c[0]: str(c[1]) for c in result.description}
    odd = {
        f.name: (f.dataType.simpleString(), types[f.name]) for f in df.schema
        if TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) != types[f.name].lower()
    }
    if odd:
        return f"types {odd}"
    want = sorted_rows(columns, result.fetchall())
    if got == want:
        return None if got else "equal, but no rows"
    only = [r for r in got if r not in set(want)][:2], [r for r in want if r not in set(got)][:2]
    return f"{len(got)} / {len(want)} rows; ours {only[0]}; sql {only[1]}"


def main() -> None:
    from codequarry.session import builder
    from registry import registered

    options = argparse.ArgumentParser()
    options.add_argument("--sf", default="/root/testdata/sf0.01")
    options.add_argument("names", nargs="*")
    args = options.parse_args()
    spark: SparkSession = (
        builder("check").master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = 0
    for name, (run, sql) in registered().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, run, sql, args.sf)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql " if sql else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - start:.2f}s"
              + (f"\n     {problem[:2500]}" if problem else ""), flush=True)
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
