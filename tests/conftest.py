from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from core_records import GOOD  # noqa: E402
from monthlake.schema import INCIDENT_COLUMNS, INCIDENT_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def incidents(spark):
    """Builds incident records from the columns that differ from `GOOD`."""

    def build(*changes: dict) -> DataFrame:
        rows = [
            tuple(({"Case Number": f"A{i}"} | row).get(c) for c in INCIDENT_COLUMNS)
            for i, row in enumerate((GOOD | {"Case Number": f"A{i}"} | c for i, c in enumerate(changes)))
        ]
        return spark.createDataFrame(rows, INCIDENT_SCHEMA)

    return build
