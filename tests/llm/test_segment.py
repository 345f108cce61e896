from __future__ import annotations

import collections
import itertools
import math

import numpy as np
import pyarrow as pa
import pytest

from monthlake.llm.registry import TOKENIZERS
from monthlake.llm.segment import Lexicon, Pieces, _answer, decode, read_model, segment

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def pieces():
    return Pieces(read_model(MODEL))


def run(pieces, texts, keys=None, samples=3):
    keys = list(range(len(texts))) if keys is None else keys
    part = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "_key": pa.array(keys, pa.int64())})
    return _answer(part, Lexicon(pieces), samples).to_pylist()


def all_segmentations(pieces, text):
    """Every way to cut the text, with its log-probability."""
    names = {pieces.library.id_to_piece(i): i for i in range(len(pieces.logs)) if pieces.logs[i]}
    form, found = "▁" + text.replace(" ", "▁"), {}

    def go(at, ids, log):
        if at == len(form):
            found[tuple(ids)] = log
        for end in range(at + 1, min(len(form), at + pieces.longest) + 1):
            if form[at:end] in names:
                piece = names[form[at:end]]
                go(end, [*ids, piece], log + pieces.logs[piece])

    go(0, [], 0.0)
    total = np.logaddexp.reduce(list(found.values()))
    return {ids: log - total for ids, log in found.items()}


def test_encoding_is_the_librarys(pieces, small):
    texts = [r.text for r in small.select("text").collect()] + ["", " ", "   ", "a  b\tc\n é 𝒳 ", "\n\n", "x ", " x", "日本語"]
    rows = run(pieces, texts)
    assert [r["ids"] for r in rows] == pieces.library.encode(texts)
    assert all(r["round_trip"] for r in rows)
    for r, text in zip(rows, texts, strict=True):
        assert len({tuple(s["ids"]) for s in r["samples"]}) == len(r["samples"])
        assert all(pieces.library.decode(s["ids"]) == text for s in r["samples"])


def test_samples_follow_the_distribution(pieces):
    """First samples by probability, sets of three by drawing without replacement."""
    p = {ids: math.exp(log) for ids, log in all_segmentations(pieces, "the").items()}
    n = 3000
    rows = run(pieces, ["the"] * n)
    included = collections.Counter()
    for drawn in itertools.permutations(p, 3):
        chance, rest = 1.0, 1.0
        for ids in drawn:
            chance, rest = chance * p[ids] / rest, rest - p[ids]
        for ids in drawn:
            included[ids] += chance
    first = collections.Counter(tuple(r["samples"][0]["ids"]) for r in rows)
    any_ = collections.Counter(tuple(s["ids"]) for r in rows for s in r["samples"])
    for ids in p:
        assert abs(first[ids] / n - p[ids]) < 0.03 and abs(any_[ids] / n - included[ids]) < 0.03
    for r in rows:
        values = [s["perturbed"] for s in r["samples"]]
        assert values == sorted(values, reverse=True)
        assert all(abs(math.exp(s["log_prob"]) - p[tuple(s["ids"])]) < 1e-9 for s in r["samples"])
    # Weighted by inclusion, the samples' probabilities add up to one on average.
    estimate = np.mean([sum(math.exp(s["log_prob"]) / s["inclusion"] for s in r["samples"]) for r in rows])
    assert abs(estimate - 1) < 0.02


def test_few_segmentations_are_all_given(pieces):
    every = all_segmentations(pieces, "the")
    (row,) = run(pieces, ["the"], samples=len(every) + 5)
    assert {tuple(s["ids"]) for s in row["samples"]} == set(every)
    assert abs(sum(math.exp(s["log_prob"]) for s in row["samples"]) - 1) < 1e-9


def test_a_row_is_sampled_alike_in_any_batch(pieces):
    texts = [f"some words of text number {i} and so on" for i in range(50)]
    whole = run(pieces, texts)
    for i in (0, 17, 49):
        (alone,) = run(pieces, [texts[i]], [i])
        assert [s["ids"] for s in alone["samples"]] == [s["ids"] for s in whole[i]["samples"]]
    other = run(pieces, texts, list(range(100, 150)))
    assert sum(a["samples"] != b["samples"] for a, b in zip(whole, other, strict=True)) > 45


def test_lexicon_forgets_without_changing_results(pieces, monkeypatch):
    texts = [f"word{i} another{i * 7} thing" for i in range(200)]
    lexicon = Lexicon(pieces)
    monkeypatch.setattr("monthlake.llm.segment._MOST_EDGES", 50)
    part = lambda a: pa.RecordBatch.from_pydict({"text": pa.array(texts[a : a + 20]), "_key": pa.array(range(a, a + 20), pa.int64())})
    rows = [r for a in range(0, 200, 20) for r in _answer(part(a), lexicon, 3).to_pylist()]
    assert [r["ids"] for r in rows] == [r["ids"] for r in run(pieces, texts)]
    assert [[s["ids"] for s in r["samples"]] for r in rows] == [[s["ids"] for s in r["samples"]] for r in run(pieces, texts)]


def test_awkward(spark, awkward, empty):
    rows = segment(awkward, MODEL).collect()
    assert len(rows) == awkward.count() and all(r.round_trip and r.n_words == 7 for r in rows)
    for r in rows:
        if not r.text:
            assert list(r.ids) == [] and [(s.log_prob, s.inclusion, list(s.ids)) for s in r.samples] == [(0.0, 1.0, [])]
    assert segment(empty, MODEL).count() == 0
    back = decode(segment(awkward, MODEL), MODEL).collect()
    assert all(r.decoded == (r.text or "") for r in back)
