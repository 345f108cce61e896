"""A stable identity for rows that have no unique column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_ID = "_row_id"
CONTENT = "content"


def place_only(rows: DataFrame) -> DataFrame:
    """Rows whose identity is the place alone, so that content is not hashed."""
    return rows.withColumn(ROW_ID, F.struct(f"{ROW_ID}.file", f"{ROW_ID}.row"))


def with_row_id(scan: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Identity of rows read straight from Parquet: content, file, and row in the file.

    Content comes first, so that equal input in other files gives the same order; the
    position only tells exact copies apart. It does not depend on how the files are
    split into tasks.
    """
    return scan.withColumn(
        ROW_ID,
        F.struct(
            F.xxhash64(*columns).alias(CONTENT),
            F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        ),
    )
