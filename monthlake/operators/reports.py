"""Counts and previews over any frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthlake.schema import MONTH_KEYS


def total_count(df: DataFrame, name: str = "total") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def month_counts(df: DataFrame) -> DataFrame:
    """Rows per month, in order."""
    return df.groupBy(*MONTH_KEYS).agg(F.count("*").alias("cnt")).orderBy(*MONTH_KEYS)


def cumulative_months(df: DataFrame) -> DataFrame:
    """Rows per month with the running total, as the table grows batch by batch.

    The window has no partition key, but sees only one row per month.
    """
    so_far = Window.orderBy(*MONTH_KEYS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = df.groupBy(*MONTH_KEYS).agg(F.count("*").alias("cnt"))
    return counts.withColumn("total", F.sum("cnt").over(so_far)).orderBy(*MONTH_KEYS)


def top_categories(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column, most frequent first."""
    counts = df.groupBy(F.col(column).alias("category")).agg(F.count("*").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), F.asc("category"))


def preview(df: DataFrame, *order: Column | str, rows: int = 10) -> DataFrame:
    """The first rows, by an order if one is given."""
    return (df.orderBy(*order) if order else df).limit(rows)


def words(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per token between white space; a leading blank gives an empty token."""
    return lines.select(F.explode(F.split(column, r"\s+")).alias("word"))


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences per word, most frequent first, equal counts by word.

    Counts are added up inside each task before the shuffle, so a frequent word costs
    no more than a rare one.
    """
    counts = words(lines, column).groupBy("word").count()
    return counts.orderBy(F.desc("count"), F.asc("word"))
