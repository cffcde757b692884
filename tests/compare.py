"""Run queries and their SQL side by side.

    python -m tests.compare [scale-folder] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def oracle(sf_dir: str, sql: str) -> pa.Table:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(
            f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')"
        )
    return con.sql(sql).to_arrow_table()


def as_rows(table: pa.Table) -> list[tuple[str, ...]]:
    """Rows as text with columns by name, in any order."""
    columns = [[str(v) for v in table[name].to_pylist()] for name in sorted(table.column_names)]
    return sorted(zip(*columns))


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(contract.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in chosen:
        start = time.time()
        got = contract.queries()[name](spark, sf_dir)
        kinds = dict(got.dtypes)
        rows = got.toArrow()
        took = time.time() - start
        sql = contract.oracle_sql().get(name)
        if sql is None:
            print(f"{name:28} {len(rows):8} rows  {took:6.2f}s  no SQL")
            continue
        want = oracle(sf_dir, sql)
        same_columns = sorted(rows.column_names) == sorted(want.column_names)
        same = same_columns and as_rows(rows) == as_rows(want)
        bad += not same
        print(f"{name:28} {len(rows):8} rows  {took:6.2f}s  {'same' if same else 'DIFFERENT'}")
        if not same:
            print("  ", kinds if len(kinds) < 12 else "", len(want))
            if same_columns:
                mine, theirs = set(as_rows(rows)), set(as_rows(want))
                print("   only here ", sorted(mine - theirs)[:2])
                print("   only there", sorted(theirs - mine)[:2])
    return bad


if __name__ == "__main__":
    sys.exit(main())
