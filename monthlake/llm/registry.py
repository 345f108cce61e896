"""The registered queries of this subpackage, one for each operator, and the pipeline."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TOKENIZERS = os.environ.get("MONTHLAKE_TOKENIZERS", "/opt/tokenizers")
_ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends the package's source to the tasks' Python, unless its path already holds it."""
    context = spark.sparkContext
    known = [Path(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT in (Path.cwd(), *known) or context.applicationId in _shipped:
        return
    name = Path(__file__).parents[1].name
    context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{name}", "zip", _ROOT, name))
    _shipped.add(context.applicationId)


def _on_tasks(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the text that is left of it when each line stays once."""
    from monthlake.llm.lines import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences that every document names, and the best Dice."""
    from monthlake.llm.licenses import scan_licenses

    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.transform("licenses", lambda m: m["license"])
    return found.select(
        "doc_id",
        F.array_join(names, ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_licenses"),
        F.coalesce(F.array_max(F.transform("licenses", lambda m: m["permille"])), F.lit(0)).cast("long").alias("best_permille"),
    )


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best by inner product for every hundredth vector."""
    from monthlake.llm.mtree import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document by two views, learned from labels that are not held out."""
    from monthlake.llm.language import held_out, learnable
    from monthlake.llm.quality import score_quality, train_quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = train_quality(docs, table(spark, sf_dir, "labels"), learnable())
    return score_quality(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score_text",
        "score_page",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set, its component and its class."""
    from monthlake.llm.jaccard import similar_documents

    return similar_documents(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    from monthlake.llm.language import held_out, identify, learnable, train_language_model

    docs = table(spark, sf_dir, "documents")
    model = train_language_model(docs.where(learnable()).select("text", "lang"))
    named = identify(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of all documents with its slot and its place in the shards."""
    from monthlake.llm.training_order import materialise
    from monthlake.work import new_folder

    docs = table(spark, sf_dir, "documents")
    return materialise(docs, new_folder(spark, "shards"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken", key=20_240_229)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    from monthlake.llm.decontaminate import items_digest, match_items, n_hit

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    matched = match_items(docs, table(spark, sf_dir, "benchmark"))
    return matched.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        items_digest(F.col("hit_items")).alias("items_sha256"),
        (n_hit() > 0).alias("contaminated"),
        F.col("longest").cast("long").alias("longest_match"),
    )


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and sampled segmentations with their scores."""
    from monthlake.llm.segment import segment

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return segment(docs, f"{TOKENIZERS}/piece_bpe_32k.model").drop("text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels that are not held out."""
    from monthlake.llm.language import held_out, learnable
    from monthlake.llm.toxicity import THRESHOLD, score_toxicity, train_toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), learnable())
    return score_toxicity(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers."""
    from monthlake.llm.alignment import align

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align(docs, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model").documents


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proof of every document, and whether what is claimed of it agrees with the root."""
    from monthlake.llm.merkle import folded, manifest, siblings_digest, without_breaks

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    proved = manifest(docs, docs.columns, "source", "doc_id", claimed=without_breaks(), claims="text")
    folding = proved.withColumn("folded_root", folded(F.col("claimed_leaf"), F.col("path")))
    return folding.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        siblings_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links, its component and whether it is the one that stays."""
    from monthlake.llm.lattice import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stages of the corpus pipeline leave of the documents, in pieces."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = (
    op1_line_dedup,
    op2_license_scans,
    op3_exact_top_k,
    op4_quality_classifier,
    op5_ngram_jaccard_join,
    op6_language_id,
    op7_training_order,
    op8_benchmark_decontamination,
    op9_sentencepiece,
    op10_toxicity,
    op11_tokenizer_alignment,
    op12_merkle_manifest,
    op13_embedding_near_dedup,
    pipeline,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _on_tasks(query) for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    from monthlake.llm import licenses, merkle

    return {"op2_license_scans": licenses.oracle(), "op12_merkle_manifest": merkle.oracle()}
