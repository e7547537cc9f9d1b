"""Compare every registered query with its SQL: ``python tests/check.py sf_dir [names]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def canonical(table: pa.Table) -> pd.DataFrame:
    frame = pd.DataFrame(
        {c: [repr(v) for v in table[c].to_pylist()] for c in sorted(table.column_names)}
    )
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def type_name(t: pa.DataType) -> str:
    return "string" if pa.types.is_string(t) or pa.types.is_large_string(t) else str(t)


def differences(ours: pa.Table, theirs: pa.Table) -> list[str]:
    found = []
    mine = {f.name: type_name(f.type) for f in ours.schema}
    wanted = {f.name: type_name(f.type) for f in theirs.schema}
    if mine != wanted:
        pairs = {
            c: (mine.get(c), wanted.get(c))
            for c in {*mine, *wanted}
            if mine.get(c) != wanted.get(c)
        }
        found.append(f"schema {pairs}")
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows {ours.num_rows} != {theirs.num_rows}")
    if not found:
        a, b = canonical(ours), canonical(theirs)
        if not a.equals(b):
            bad = (a != b).any(axis=1)
            columns = [c for c in a.columns if (a[c] != b[c]).any()]
            found.append(
                f"values differ in {bad.sum()} rows, columns {columns[:6]}: "
                f"{a[bad].head(2)[columns[:4]].values.tolist()} vs "
                f"{b[bad].head(2)[columns[:4]].values.tolist()}"
            )
    return found


def arrow(result) -> pa.Table:
    table = result.to_arrow_table() if hasattr(result, "to_arrow_table") else result.arrow()
    return table if isinstance(table, pa.Table) else table.read_all()


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as spark_entry

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    queries, oracles = spark_entry.queries(), spark_entry.oracle_sql()
    failed = 0
    for name, q in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            ours = q(spark, folder).toArrow()
            took = time.time() - start
            if name not in oracles:
                print(f"rows {name} {ours.num_rows} {took:.1f}s {ours.slice(0, 3).to_pylist()}")
                continue
            theirs = arrow(con.sql(oracles[name]))
            problems = differences(ours, theirs)
        except Exception as e:  # noqa: BLE001
            problems, took, ours = [f"{type(e).__name__}: {str(e)[:1500]}"], 0, None
        failed += bool(problems)
        rows = ours.num_rows if ours is not None else "-"
        print("FAIL" if problems else "ok  ", name, rows, f"{took:.1f}s", *problems, flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
