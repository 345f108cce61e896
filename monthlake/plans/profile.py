"""A first look at CSV files of unknown shape."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from monthlake.operators.reports import preview


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema of a frame as rows."""
    fields = [
        (place, f.name, f.dataType.simpleString(), f.nullable)
        for place, f in enumerate(df.schema, start=1)
    ]
    return df.sparkSession.createDataFrame(
        fields, "position int, column string, type string, nullable boolean"
    )


_NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
#: Types from the narrowest on, each with a condition on the trimmed text besides the cast.
TYPES: tuple[tuple[str, str], ...] = (
    ("int", r"[+-]?[0-9]+"),
    ("bigint", r"[+-]?[0-9]+"),
    ("double", f"{_NUMBER}|NaN|-?Infinity"),
    ("date", r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"),
    ("timestamp", r"[0-9]{4}-.*"),
    ("boolean", "(?i)true|false"),
)


def infer_types(texts: DataFrame, sampling_ratio: float = 1.0) -> tuple[StructType, dict[str, int], int]:
    """Schema, nulls per column and rows of a frame of strings, in one aggregate over one scan.

    A column has the first of ``TYPES`` that all of its values fit, and is a string where
    none is or where there are no values. A ratio below 1 tries the types on rows chosen by
    their hash only; rows and nulls are always counted in all.
    """
    names = texts.columns
    rows = texts.toDF(*(f"c{i}" for i in range(len(names))))
    chosen = F.lit(True) if sampling_ratio >= 1 else F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)) < int(sampling_ratio * (1 << 20))
    counts = [F.count("*").alias("rows")]
    for column in rows.columns:
        text = F.trim(column)
        counts.append(F.count_if(F.col(column).isNull()).alias(f"{column}_null"))
        counts.append(F.count_if(chosen & F.col(column).isNotNull()).alias(f"{column}_any"))
        for kind, pattern in TYPES:
            fits = text.rlike(f"^({pattern})$") & text.try_cast(kind).isNotNull()
            counts.append(F.count_if(chosen & fits).alias(f"{column}_{kind}"))
    found = rows.agg(*counts).first()
    fields, nulls = [], {}
    for name, column in zip(names, rows.columns, strict=True):
        values = found[f"{column}_any"]
        kind = next((k for k, _ in TYPES if values and found[f"{column}_{k}"] == values), "string")
        fields.append(f"`{name.replace('`', '``')}` {kind}")
        nulls[name] = found[f"{column}_null"]
    return StructType.fromDDL(", ".join(fields)) if fields else StructType([]), nulls, found["rows"]


@dataclass(frozen=True)
class CsvProfile:
    """What `profile_csv` gives: the data, and small frames about it."""

    data: DataFrame
    columns: DataFrame
    total: DataFrame
    preview: DataFrame
    nulls: DataFrame


def profile_csv(
    spark: SparkSession, path: str, view: str = "data", sampling_ratio: float = 1.0
) -> CsvProfile:
    """Read CSV files with a header line, infer their types and name them ``view`` for SQL.

    ``path`` may be a glob. Types, nulls and rows come from one scan; a smaller
    ``sampling_ratio`` infers types from fewer lines.
    """
    schema, nulls, rows = infer_types(spark.read.option("header", True).csv(path), sampling_ratio)
    data = spark.read.option("header", True).schema(schema).csv(path)
    data.createOrReplaceTempView(view)
    total = spark.createDataFrame([(rows,)], "total_rows bigint")
    missing = spark.createDataFrame(list(nulls.items()), "column string, nulls bigint")
    named = spark.table(view)
    return CsvProfile(data, schema_rows(named), total, preview(named), missing)
