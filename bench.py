"""Time the headline jobs and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Beside the sum of
the headline jobs the line holds a comparison on the same input: the batch as this
library runs it (marked rows are written once and read twice), and as five separate
actions over a plan that nothing keeps. ``process_all_months_large`` deals the work as
batches above ``rows_per_task`` do.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import queries as q
from monthlake import BatchMonth, Zones, fixtures
from monthlake.operators import (
    ROW_ID,
    classify,
    cumulative_months,
    dedupe_first,
    month_counts,
    split,
    word_count,
)
from monthlake.plans import (
    CURATED_TABLE,
    build_source,
    process_months,
    register_curated,
    verify_lake,
    verify_month,
)
from monthlake.sinks import write_curated, write_rejected, write_report_csv
from monthlake.sources import count_months, read_months, read_source


def session(cpus: str, work: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("monthlake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", work)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    """Compute all rows and columns of a frame."""
    df.write.format("noop").mode("overwrite").save()


def five_actions(spark: SparkSession, zones: Zones, month: BatchMonth) -> None:
    """One month with the library's own steps, counted three times and written twice.

    Nothing is kept between the actions, so each starts from the scan.
    """
    rows = read_months(spark, zones, [month])
    valid, rejected = split(dedupe_first(classify(rows), row_id=ROW_ID))
    for counted in (rows, valid, rejected):
        counted.count()
    write_curated(valid, zones)
    write_rejected(rejected, zones)


def timed(job: Callable[[], object], repeats: int = 1) -> float:
    """Seconds of the fastest run."""
    best = float("inf")
    for _ in range(repeats):
        start = time.perf_counter()
        job()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="monthlake-bench-")
    spark = session(cpus, work)
    zones, apart = Zones(f"{work}/lake"), Zones(f"{work}/five-actions")

    records = fixtures.incidents(spark, sf_dir)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    run(records.limit(1))  # starts the session's executors

    times = {"build_source": timed(lambda: build_source(records, zones))}
    months = sorted(count_months(read_source(spark, zones).where("year > 0")))
    month = months[len(months) // 2]
    times |= {
        "process_all_months": timed(lambda: process_months(spark, zones, months)),
        "process_all_months_large": timed(
            lambda: process_months(spark, zones, months, rows_per_task=500)
        ),
        "process_one_month": timed(lambda: process_months(spark, zones, [month]), 3),
        "register_curated": timed(lambda: register_curated(spark, zones)),
        "dq_classified": timed(lambda: run(q.classified(spark, sf_dir)), 2),
        "month_counts": timed(lambda: run(month_counts(spark.table(CURATED_TABLE))), 2),
        "cumulative_months": timed(lambda: run(cumulative_months(spark.table(CURATED_TABLE))), 2),
        "month_slice": timed(lambda: run(spark.table(CURATED_TABLE).where(month.predicate())), 2),
        "verify_month": timed(lambda: verify_month(spark, zones, month), 2),
        "verify_lake": timed(lambda: run(verify_lake(spark, zones)), 2),
        "word_count": timed(lambda: run(word_count(documents, "text")), 2),
        "report_csv": timed(
            lambda: write_report_csv(
                word_count(documents, "text"),
                f"{work}/report",
                single_file=True,
                order=[F.desc("count"), "word"],
            ),
            2,
        ),
    }

    # The same source for both forms; the five-action form takes one month per run.
    build_source(records, apart)
    five = timed(lambda: five_actions(spark, apart, month), 3)
    five_all = timed(lambda: [five_actions(spark, apart, m) for m in months])

    print(
        json.dumps(
            {
                "metric": "headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "comparison": {
                    "five_actions_one_month": five,
                    "one_pass_one_month": times["process_one_month"],
                    "five_actions_all_months": five_all,
                    "one_pass_all_months": times["process_all_months"],
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
