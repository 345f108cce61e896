from __future__ import annotations

import math
import zlib

import pytest

from monthlake.llm.language import held_out, identify, keep_identified, learnable, train_language_model


def test_held_out_accuracy(spark, small):
    model = train_language_model(small.where(learnable()))
    rows = identify(small.where(held_out()), model).collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert len(rows) > 30 and right >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_is_crc(small):
    for r in small.select("doc_id", held_out().alias("h")).collect():
        assert r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_counts_are_the_texts_runs(spark):
    """One text of three characters has six runs, wherever they fall."""
    model = train_language_model(spark.createDataFrame([("aBc", "xx"), ("d", "yy")], "text string, lang string"))
    assert model.languages == ["xx", "yy"]
    again = train_language_model(spark.createDataFrame([("d", "yy"), ("abc", "xx")], "text string, lang string"))
    assert (model.logs == again.logs).all()


def test_awkward(spark, awkward, small):
    model = train_language_model(small)
    rows = identify(awkward, model).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in model.languages and r.n_words == 7


def test_empty_and_unlearnable(spark, empty, awkward):
    model = train_language_model(empty)
    assert identify(empty, model).count() == 0
    assert {r.lang_pred for r in identify(awkward, model).collect()} == {"und"}
    assert keep_identified(empty).columns == empty.columns


def test_kept_documents(small):
    kept = keep_identified(small)
    assert kept.columns == small.columns and kept.count() >= 0.97 * small.count()


TINY = [("aba", "xx"), ("ab", "xx"), ("bb c", "yy"), (None, "yy"), ("é", None)]


def by_hand(rows, text):
    """Posteriors by counting runs in dicts; runs that share a bucket count together, as in the model."""
    import numpy as np

    from monthlake.llm.language import BITS, ORDERS, _ngrams

    def buckets(t):
        data = t.lower().encode()
        return [b for found, _ in _ngrams(np.frombuffer(data, np.uint8), np.array([0, len(data)])) for b in found.tolist()]

    runs = [text[i : i + n] for n in ORDERS for i in range(len(text) - n + 1)]
    assert len(buckets(text)) == len(runs)
    assert len(set(zip(buckets(text), runs, strict=True))) == len(set(runs))  # equal runs, equal buckets
    counts, of_lang = {}, {}
    for t, lang in rows:
        if t is not None and lang is not None:
            of_lang[lang] = of_lang.get(lang, 0) + 1
            for b in buckets(t):
                counts.setdefault(lang, {})[b] = counts.setdefault(lang, {}).get(b, 0) + 1
    logs = {}
    for lang, own in counts.items():
        total = sum(own.values())
        logs[lang] = math.log(of_lang[lang] / sum(of_lang.values()))
        logs[lang] += sum(math.log((own.get(b, 0) + 0.5) / (total + 0.5 * 2**BITS)) for b in buckets(text)) / len(ORDERS)
    top = max(logs.values())
    weights = {lang: math.exp(x - top) for lang, x in logs.items()}
    return {lang: w / sum(weights.values()) for lang, w in weights.items()}


@pytest.mark.parametrize("per_block", [1, 400])
def test_posteriors_by_hand(spark, per_block):
    model = train_language_model(spark.createDataFrame(TINY, "text string, lang string"), per_block)
    asked = ["ab", "bb", "ABBA c", "zz", "c"]
    found = identify(spark.createDataFrame([(t,) for t in asked], "text string"), model).collect()
    for row in found:
        expected = by_hand(TINY, row.text.lower())
        best = max(sorted(expected), key=expected.get)
        assert row.lang_pred == best and abs(row.score - expected[best]) < 1e-5


def test_more_languages_than_a_matrix_holds(spark):
    """Three languages a pass: the same answers as in one."""
    rows = [(f"{chr(97 + i)}{chr(98 + i)} " * 5, f"l{i}") for i in range(10)]
    df = spark.createDataFrame(rows, "text string, lang string")
    few, all_at_once = (identify(df, train_language_model(df, n)).orderBy("text").collect() for n in (3, 400))
    for a, b in zip(few, all_at_once, strict=True):
        assert a.lang_pred == b.lang_pred == a.lang and abs(a.score - b.score) < 1e-9


def test_last_pass_gives_back_no_lowered_copy(spark):
    """Only the last pass drops the lowered texts; earlier ones still need them."""
    import pyarrow as pa

    from monthlake.llm.language import _answer

    model = train_language_model(spark.createDataFrame([("abc", "xx"), ("def", "yy")], "text string, lang string"))
    block = next(model.blocks())
    part = pa.RecordBatch.from_pydict(
        {"text": ["ABC", None], "_lower": ["abc", None], "_lang": [None, None], "_best": [float("-inf")] * 2, "_total": [float("-inf")] * 2},
        schema=pa.schema([("text", pa.string()), ("_lower", pa.string()), ("_lang", pa.string()), ("_best", pa.float64()), ("_total", pa.float64())]),
    )
    middle, last = _answer(part, block), _answer(part, block, last=True)
    assert middle.column("_lower").to_pylist() == ["abc", None]
    assert last.column("_lower").null_count == 2 and last.column("text").to_pylist() == ["ABC", None]
    assert last.column("_lang").to_pylist() == middle.column("_lang").to_pylist() == ["xx", None]
