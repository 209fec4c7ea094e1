"""Compare a registered query with its SQL, by column name, type class and row multiset."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(value) if isinstance(value, float) else value


def rows_of(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    kinds = {n: str(table.schema.field(n).type).replace("large_", "") for n in names}
    return names, kinds, Counter(tuple(_plain(v) for v in row) for row in zip(*columns))


def difference(df, con, sql: str) -> str | None:
    """None if both give the same, else what differs."""
    names, kinds, rows = rows_of(df.toArrow())
    table = con.sql(sql).to_arrow_table()
    other_names, other_kinds, other_rows = rows_of(table)
    if names != other_names:
        return f"columns {names} / {other_names}"
    if rows != other_rows:
        only = list((rows - other_rows).items())[:3]
        other = list((other_rows - rows).items())[:3]
        return f"rows {sum(rows.values())} / {sum(other_rows.values())}: {only} / {other}"
    if kinds != other_kinds:
        odd = {n: (kinds[n], other_kinds[n]) for n in names if kinds[n] != other_kinds[n]}
        return f"types {odd}"
    return None


def main() -> int:
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as driver
    from pyspark.sql import SparkSession

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = connect(sf_dir), driver.queries(), driver.oracle_sql()
    failed = 0
    for name in names or queries:
        found = difference(queries[name](spark, sf_dir), con, sql[name])
        failed += found is not None
        print(name, found or "same", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
