"""Schemas of the incident records in each zone of the lake."""

from __future__ import annotations

from pyspark.sql import types as T

# The 22 fields of an incident record, in file order.
INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("Case Number", T.StringType()),
        T.StructField("Date", T.StringType()),
        T.StructField("Block", T.StringType()),
        T.StructField("IUCR", T.StringType()),
        T.StructField("Primary Type", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Location Description", T.StringType()),
        T.StructField("Arrest", T.BooleanType()),
        T.StructField("Domestic", T.BooleanType()),
        T.StructField("Beat", T.IntegerType()),
        T.StructField("District", T.IntegerType()),
        T.StructField("Ward", T.IntegerType()),
        T.StructField("Community Area", T.IntegerType()),
        T.StructField("FBI Code", T.StringType()),
        T.StructField("X Coordinate", T.IntegerType()),
        T.StructField("Y Coordinate", T.IntegerType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("Updated On", T.StringType()),
        T.StructField("Latitude", T.DoubleType()),
        T.StructField("Longitude", T.DoubleType()),
        T.StructField("Location", T.StringType()),
    ]
)
INCIDENT_COLUMNS = INCIDENT_SCHEMA.fieldNames()

# Spark resolves names without regard to case, so the data column ``Year`` cannot
# live beside the partition column ``year``.
REPORTED_YEAR = "YearReported"
SOURCE_ERROR = "_source_error"
REJECT_REASON = "reject_reason"
# Partition columns of the stored zones.
MONTH_KEYS = ["year", "month"]
# The same two on rows in work, which still have their ``Year``.
BATCH_KEYS = ["_year", "_month"]

MONTH_FIELDS = [T.StructField(name, T.IntegerType()) for name in MONTH_KEYS]

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField(REPORTED_YEAR if f.name == "Year" else f.name, f.dataType)
        for f in INCIDENT_SCHEMA
    ]
    + [T.StructField(SOURCE_ERROR, T.StringType())]
    + MONTH_FIELDS
)

CURATED_COLUMNS = [name for name in INCIDENT_COLUMNS if name != "Year"]
CURATED_SCHEMA = T.StructType([INCIDENT_SCHEMA[name] for name in CURATED_COLUMNS] + MONTH_FIELDS)

BATCH_MONTH = "batch_month"
REJECTED_COLUMNS = INCIDENT_COLUMNS + [REJECT_REASON]
REJECTED_SCHEMA = T.StructType(
    list(INCIDENT_SCHEMA)
    + [T.StructField(REJECT_REASON, T.StringType()), T.StructField(BATCH_MONTH, T.StringType())]
)
