"""The curated zone as a partitioned SQL table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.schema import CURATED_COLUMNS, CURATED_SCHEMA, MONTH_KEYS
from monthlake.zones import Zones

CURATED_TABLE = "default.curated_incidents"


def register_curated(spark: SparkSession, zones: Zones, table: str = CURATED_TABLE) -> None:
    """Create the external table if it is not there, and make all months visible.

    Safe to run after every batch: data is not touched, and months that were written
    since the last run, or written again, are picked up.
    """
    columns = ", ".join(
        f"`{name}` {CURATED_SCHEMA[name].dataType.simpleString()}" for name in CURATED_COLUMNS
    )
    keys = ", ".join(f"{key} INT" for key in MONTH_KEYS)
    location = zones.curated.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({keys}) LOCATION '{location}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {table}")
    # Drops the file lists of an earlier query, which name the files of replaced months.
    spark.catalog.refreshTable(table)


def table_partitions(spark: SparkSession, table: str = CURATED_TABLE) -> DataFrame:
    """The months the catalog knows, as numbers, in order; all of them."""
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    values = {
        key: F.regexp_extract("partition", rf"(?:^|/){key}=(\d+)(?:/|$)", 1).cast("int")
        for key in MONTH_KEYS
    }
    return parts.select(*[value.alias(key) for key, value in values.items()]).orderBy(*MONTH_KEYS)


def list_partitions(df: DataFrame) -> DataFrame:
    """The distinct months of a partitioned scan, in order; reads footers only."""
    return df.select(*MONTH_KEYS).distinct().orderBy(*MONTH_KEYS)
