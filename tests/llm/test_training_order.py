from __future__ import annotations

import collections
import zlib

import numpy as np
import pytest

from monthlake.llm.registry import TOKENIZERS
from monthlake.llm.training_order import Reader, Tokens, materialise, permuted

RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64, 1000, 4097])
def test_permutation(n):
    slots = [permuted(np.arange(n), n, key) for key in (1, 2)]
    assert all(sorted(s.tolist()) == list(range(n)) for s in slots)
    if n > 16:
        assert (slots[0] != slots[1]).any() and (slots[0] != np.arange(n)).any()


def test_slots_of_neighbours_are_apart():
    slots = permuted(np.arange(10_000), 10_000, 7)
    assert abs(np.corrcoef(np.arange(10_000), slots)[0, 1]) < 0.05


def rebuilt(path, rows, tokens):
    """All ids of the shards, and the texts that are whole within a sequence."""
    sequences = list(Reader(path).sequences())
    texts = collections.Counter()
    for ids, row in zip(sequences, rows, strict=True):
        assert zlib.crc32(ids.tobytes()) == row.crc32 and (ids[row.n_tokens :] == tokens.end).all()
        parts = tokens.decode(ids[: row.n_tokens])
        assert len(parts) == len(row.doc_ids)
        texts.update(zip(row.doc_ids[1:-1], parts[1:-1], strict=True))
    return sequences, texts


def test_round_trip_and_resuming(spark, small, tmp_path):
    tokens = Tokens(open(RANKS, "rb").read())
    path = str(tmp_path / "shards")
    rows = materialise(small.repartition(3), path, RANKS, key=3, length=256, shard_bytes=20_000).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows))) and len({r.shard for r in rows}) > 10
    sequences, texts = rebuilt(path, rows, tokens)
    docs = {r.doc_id: r.text for r in small.collect()}
    assert len(texts) > 10 and all(docs[d] == t for d, t in texts)
    assert sum(r.n_tokens for r in rows) == sum(len(tokens.encode(t)) for t in docs.values())
    # Every document is in the shards, its pieces in as many sequences as it needs.
    assert {d for r in rows for d in r.doc_ids} == set(docs)
    resumed = list(Reader(path).sequences(37, 90))
    assert len(resumed) == 53 and all((a == b).all() for a, b in zip(resumed, sequences[37:90], strict=True))
    # Another key, another order of the same sequences; the same key, the same bytes.
    other = materialise(small.repartition(3), str(tmp_path / "other"), RANKS, key=4, length=256).orderBy("slot").collect()
    assert [r.crc32 for r in other] != [r.crc32 for r in rows] and sorted(r.crc32 for r in other) == sorted(r.crc32 for r in rows)


def test_awkward(spark, awkward, empty, tmp_path):
    path = str(tmp_path / "awkward")
    rows = materialise(awkward.coalesce(1), path, RANKS, length=64).orderBy("slot").collect()
    ids = collections.Counter(d for r in rows for d in r.doc_ids)
    assert set(ids) == {None, 1, 4, 5, 6, 7, 8, 9} and len(list(Reader(path).sequences())) == len(rows)
    assert materialise(empty, str(tmp_path / "none"), RANKS).count() == 0 and len(Reader(str(tmp_path / "none"))) == 0


def test_texts_without_an_id_are_packed(spark, tmp_path):
    """Null stands for them, and for no other id, whatever its value."""
    tokens = Tokens(open(RANKS, "rb").read())
    rows = [(None, "first text"), (0, "second text"), (-(2**63), "third text"), (None, "fourth text"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    (found,) = materialise(df, str(tmp_path / "shards"), RANKS, length=64).collect()
    assert found.doc_ids == [None, 0, -(2**63), None]
    (ids,) = Reader(str(tmp_path / "shards")).sequences()
    assert tokens.decode(ids[: found.n_tokens]) == ["first text", "second text", "third text", "fourth text"]
