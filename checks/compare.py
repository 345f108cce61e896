"""Run every registered query and its SQL on one scale and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries


def comparable(value: object) -> str:
    return "NULL" if value is None else str(value)


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple[str, ...]]]:
    with duckdb.connect() as db:
        db.execute("SET TimeZone = 'UTC'")
        for path in sorted(Path(sf_dir).glob("*.parquet")):
            db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        cursor = db.execute(sql)
        names = [column[0] for column in cursor.description]
        return names, cursor.fetchall()


def by_name(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple[str, ...]]]:
    """Rows with their columns in order of name, sorted."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(
        tuple(comparable(row[i]) for i in order) for row in rows
    )


def compare(spark: SparkSession, sf_dir: str, name: str) -> str:
    """``ok``, ``rows only`` or what differs."""
    df = queries()[name](spark, sf_dir)
    spark_side = by_name(df.columns, [tuple(row) for row in df.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        return f"rows only ({len(spark_side[1])})"
    oracle_side = by_name(*oracle_rows(sf_dir, sql))
    if spark_side == oracle_side:
        return f"ok ({len(spark_side[1])})"
    if spark_side[0] != oracle_side[0]:
        return f"COLUMNS {spark_side[0]} != {oracle_side[0]}"
    only_spark = sorted(set(spark_side[1]) - set(oracle_side[1]))[:2]
    only_oracle = sorted(set(oracle_side[1]) - set(spark_side[1]))[:2]
    return f"ROWS {len(spark_side[1])} / {len(oracle_side[1])}: {only_spark} / {only_oracle}"


def main(sf_dir: str, names: list[str]) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or queries():
        start = time.perf_counter()
        result = compare(spark, sf_dir, name)
        print(f"{name:24s} {time.perf_counter() - start:6.1f} s  {result}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
