"""A corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns documents with the same columns, but
for the last, which adds the pieces. What a stage rejects, the next one does not see:

1. language: documents whose language is not known with a probability of one half go.
2. lines: of each group of similar lines the first stays; documents without any line left go.
3. copies: of each group of similar documents the one with the smallest id stays.
4. benchmark: passages of benchmark items are cut out; documents that are half passages go.
5. pieces: SentencePiece ids and sampled segmentations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthlake.llm.decontaminate import decontaminate
from monthlake.llm.jaccard import keep_first_of_groups
from monthlake.llm.language import keep_identified
from monthlake.llm.lines import keep_new_lines
from monthlake.llm.registry import TOKENIZERS, ship_package, table
from monthlake.llm.segment import segment
from monthlake.work import new_folder, remove_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_new_lines(docs)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_first_of_groups(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return segment(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("copies", copies),
    ("benchmark", benchmark),
    ("pieces", pieces),
]

#: Naive Bayes, MinHash and the sampled segmentations have no SQL; a test compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table that the next one reads."""
    docs, last = table(spark, sf_dir, "documents"), ""
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/docs")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/docs")
        if last:
            remove_folder(spark, last)
        last = folder
    return docs
