"""Run queries beside their SQL and report differences: python tools/compare.py [folder] [names...]"""

from __future__ import annotations

import importlib
import math
import os
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def _same(left: tuple, right: tuple) -> bool:
    for a, b in zip(left, right):
        both_nan = isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b)
        if a != b and not both_nan:
            return False
    return True


def compare(spark: SparkSession, folder: str, name: str, function, sql: str | None) -> tuple[bool, str]:
    started = time.time()
    df = function(spark, folder)
    columns = sorted(df.columns)
    mine = sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)
    seconds = time.time() - started
    if sql is None:
        return True, f"{len(mine)} rows, no SQL, {seconds:.2f} s"
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    result = connection.sql(sql)
    if sorted(result.columns) != columns:
        return False, f"columns {columns} / {sorted(result.columns)}"
    types = dict(zip(result.columns, result.types))
    order = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(connection.sql(f"select {order} from ({sql})").fetchall(), key=_key)
    if len(mine) != len(theirs):
        return False, f"{len(mine)} rows / {len(theirs)}"
    for a, b in zip(mine, theirs):
        if not _same(a, b):
            return False, f"{dict(zip(columns, a))}\n   / {dict(zip(columns, b))}"
    spark_types = dict(df.dtypes)
    pairs = {(spark_types[c], str(types[c])) for c in columns}
    return True, f"{len(mine)} rows, {seconds:.2f} s, types {sorted(pairs)}"


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    entry = importlib.import_module("__spark_entry__")
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = (
        SparkSession.builder.master(os.environ.get("COMPARE_MASTER", "local[8]"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        try:
            good, text = compare(spark, folder, name, queries[name], oracles.get(name))
        except Exception as error:  # report and go on with the next query
            good, text = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not good
        print("ok  " if good else "FAIL", name, text, flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
