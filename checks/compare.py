"""Run registered queries against their SQL: python -m checks.compare FOLDER [name ...]."""

from __future__ import annotations

import decimal
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.base import ORACLES, QUERIES, sql
from reclink.sources.adapters import BASE


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, (decimal.Decimal, float)):
        return f"{float(value):.5f}"
    return str(value)


def _rows(rows, order):
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, folder: str, name: str) -> str:
    """Empty when both sides agree, else the first difference."""
    df = QUERIES[name](spark, folder)
    columns = df.columns
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return "" if got else "no rows"
    cursor = con.execute(sql(ORACLES[name]))
    wanted_columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(wanted_columns):
        return f"columns {sorted(columns)} != {sorted(wanted_columns)}"
    names = sorted(columns)
    a = _rows(got, [columns.index(n) for n in names])
    b = _rows(cursor.fetchall(), [wanted_columns.index(n) for n in names])
    if len(a) != len(b):
        extra, missing = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return f"rows {len(a)} != {len(b)}; only here {extra}; only there {missing}"
    for x, y in zip(a, b):
        if x != y:
            return f"{names}\n   {x}\n   {y}"
    return ""


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        # The test tables are small for their work per row, so keep partitions apart that a cluster would merge.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def main(folder: str, names: list[str]) -> int:
    import checks.queries  # noqa: F401

    spark, con = session(), connect(folder)
    bad = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem)
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'BAD' if problem else 'ok '} {name} [{kind}] {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} bad of {len(names or QUERIES)}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
