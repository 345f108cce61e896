from __future__ import annotations

import corpus_pipeline
from monthlake.llm import registry
from monthlake.llm.language import UNKNOWN

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark, small):
    """Each stage on its predecessor's rows; what it decides takes effect."""
    docs, seen = small, {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SMALL)
        seen[name] = {r.doc_id: r.text for r in result.select("doc_id", "text").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == small.columns, name
        docs = spark.createDataFrame(result.collect(), result.schema)
    texts = {r.doc_id: r.text for r in small.collect()}
    assert seen["language"].keys() <= texts.keys() and len(seen["language"]) > 0.95 * len(texts)
    lines = [x.strip().lower() for t in seen["lines"].values() for x in t.split("\n") if x.strip()]
    assert len(lines) == len(set(lines))
    assert seen["copies"].keys() <= seen["lines"].keys() and seen["pieces"] == seen["benchmark"]
    assert UNKNOWN not in seen


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and all(r.round_trip and len(r.samples) >= 1 for r in rows)


def test_one_query_per_operator():
    names = list(registry.queries())
    assert [n.split("_")[0] for n in names] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert registry.oracle_sql().keys() <= set(names)


def test_awkward(spark, awkward, empty):
    for docs in (awkward.select("doc_id", "text", "lang", "source", "n_chars"), empty):
        for _, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, SMALL)
            assert result.count() <= docs.count() and set(docs.columns) <= set(result.columns)
