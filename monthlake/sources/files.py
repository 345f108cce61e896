"""Scans of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthlake.schema import INCIDENT_SCHEMA


def read_incidents_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Incident records from CSV with a header line, typed by position.

    Values that do not fit their type become null, short lines end in nulls and long
    ones are cut, so no record is lost. ``options`` go to the CSV reader, such as
    ``multiLine=True`` for quoted line breaks (which makes a file one task).
    """
    return spark.read.options(header=True, **options).schema(INCIDENT_SCHEMA).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as one ``value`` row per line."""
    return spark.read.text(path)
