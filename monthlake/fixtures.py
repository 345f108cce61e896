"""Incident records derived from the ``orders`` table, with planted defects.

Every order gives one record, and every 53rd a second one with the same ID and date.
The same expressions are given as DuckDB text in ``__spark_entry__``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.functions import event_time
from monthlake.schema import BATCH_KEYS, INCIDENT_COLUMNS

# Unique per record, so it serves as row identity.
ROW_ID = "Case Number"

_DATE = "date_format(o_orderdate + make_dt_interval(0, 0, 0, k % 86400), 'MM/dd/yyyy hh:mm:ss a')"

_COLUMNS = {
    "ID": "CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(k AS STRING) END",
    "Case Number": "concat(tag, CAST(k AS STRING))",
    "Date": f"""CASE WHEN k % 89 = 0 THEN 'not a date'
        WHEN k % 101 = 0 THEN '1/5/1999 1:02:03 PM'
        WHEN k % 103 = 0 THEN '02/30/1999 01:00:00 AM'
        WHEN k % 107 = 0 THEN NULL ELSE {_DATE} END""",
    "Block": "concat(lpad(CAST(k % 1000 AS STRING), 3, '0'), 'XX W MAIN ST')",
    "IUCR": "lpad(CAST(c % 9999 AS STRING), 4, '0')",
    "Primary Type": "CASE WHEN k % 83 = 0 THEN NULL ELSE o_orderpriority END",
    "Description": "concat('STATUS ', o_orderstatus)",
    "Location Description": "CASE WHEN k % 43 = 0 THEN NULL ELSE 'STREET' END",
    "Arrest": "o_orderstatus = 'F'",
    "Domestic": "k % 5 = 0",
    "Beat": "CAST(c % 2535 AS INT)",
    "District": "CAST(c % 25 + 1 AS INT)",
    "Ward": "CAST(c % 50 + 1 AS INT)",
    "Community Area": "CAST(c % 77 + 1 AS INT)",
    "FBI Code": "lpad(CAST(c % 26 AS STRING), 2, '0')",
    "X Coordinate": "CAST(1090000 + k % 110000 AS INT)",
    "Y Coordinate": "CAST(1810000 + k % 140000 AS INT)",
    "Year": """CAST(CASE WHEN k % 79 = 0 THEN year(o_orderdate) - 1
        WHEN k % 73 = 0 THEN NULL ELSE year(o_orderdate) END AS INT)""",
    "Updated On": "'02/10/2018 03:50:01 PM'",
    "Latitude": """CASE WHEN k % 71 = 0 THEN NULL WHEN k % 67 = 0 THEN CAST(40.0 AS DOUBLE)
        WHEN k % 61 = 0 THEN CAST('NaN' AS DOUBLE)
        ELSE CAST(41.0 AS DOUBLE) + CAST(k % 2001 AS DOUBLE) / CAST(1000 AS DOUBLE) END""",
    "Longitude": """CASE WHEN k % 59 = 0 THEN NULL WHEN k % 67 = 0 THEN CAST(-80.0 AS DOUBLE)
        WHEN k % 47 = 0 THEN CAST(-89.0 AS DOUBLE)
        ELSE CAST(-88.5 AS DOUBLE) + CAST(k % 1501 AS DOUBLE) / CAST(1000 AS DOUBLE) END""",
    "Location": "concat('(', CAST(k % 2001 AS STRING), ', ', CAST(k % 1501 AS STRING), ')')",
}


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 22-column records. Run with the session time zone UTC."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumnsRenamed(
        {"o_orderkey": "k", "o_custkey": "c"}
    )
    tags = F.expr("explode(CASE WHEN k % 53 = 0 THEN array('A', 'B') ELSE array('A') END)")
    tagged = orders.withColumn("tag", tags)
    return tagged.select(*[F.expr(_COLUMNS[name]).alias(name) for name in INCIDENT_COLUMNS])


def batched(records: DataFrame) -> DataFrame:
    """Add the batch keys of each record; null where the date does not parse."""
    year, month = BATCH_KEYS
    return (
        records.withColumn("_time", event_time("Date"))
        .withColumns({year: F.year("_time"), month: F.month("_time")})
        .drop("_time")
    )
