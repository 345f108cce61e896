from __future__ import annotations

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from monthlake.llm import alignment
from monthlake.llm.alignment import Cutter, align, byte_level_bytes
from monthlake.llm.registry import TOKENIZERS

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
TEXTS = [
    "Hello there, naïve Straße! 12345 tokens", " two  spaces\n\n\ttab ", "日本語 and 😀 emoji", "▁ a mark", "x", "", None,
    "<|endoftext|> </s> <s> <unk> <0x41>", "don't we'll I'VE", "\x00\x1c\x85  odd", "a" * 3000, " " * 50, "été ß ſ ŉ ǆ ª µ ² ½",
    "Hello there, naïve Straße! 12345 tokens",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(libraries, text):
    """(id, bytes) of both tokenizers, each text encoded whole; none where bytes differ."""
    a, b = libraries
    if not text:
        return [], []
    values, spaced = byte_level_bytes(), " " + text
    left = [(i, bytes(values[c] for c in a.id_to_token(i))) for i in a.encode(spaced, add_special_tokens=False).ids]
    right = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
    if any(b"".join(x for _, x in side) != spaced.encode() for side in (left, right)):
        return [], []
    return left, right


def brute(libraries, rows):
    def ends(side):
        out, n = [], 0
        for i, x in side:
            n += len(x)
            out.append((n, i))
        return out

    linked, lines = [], []
    for _, text in rows:
        left, right = map(ends, tokens(libraries, text))
        by_end = dict(right)
        linked.append([(i, by_end[n]) for n, i in left if n in by_end])
        cuts = sorted({n for n, _ in left} & {n for n, _ in right})
        group_of = {n: k for k, n in enumerate(cuts)}
        inside = [([], []) for _ in cuts]
        for number, side in enumerate((left, right)):
            k = 0
            for n, i in side:
                inside[k][number].append(str(i))
                k = group_of.get(n, k - 1) + 1
        groups = ["|".join(map(",".join, group)) for group in inside]
        lines.append((len(left), len(right), len(cuts), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    counts = Counter(pair for links in linked for pair in links)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    out = [
        (doc_id, a, b, n, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), digest)
        for (doc_id, _), (a, b, n, digest), links in zip(rows, lines, linked, strict=True)
    ]
    return sorted(out, key=str), {(i, j, n, n == best[j]) for (i, j), n in counts.items()}


def check(spark, libraries, rows, df, **settings):
    found = align(df, A, B, **settings)
    documents, pairs = brute(libraries, rows)
    assert sorted((tuple(r) for r in found.documents.collect()), key=str) == documents
    listed = [tuple(r) for r in found.pairs.collect()]
    assert len(listed) == len(pairs) and set(listed) == pairs


@pytest.mark.parametrize("frequent", [1, 50, 1 << 16])
def test_as_by_hand(spark, libraries, frequent):
    """Pairs looked up, joined, and some of each."""
    rows = [(i if i % 5 else None, t) for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS n", "3 AS pair", "'x' AS rest").repartition(3)
    check(spark, libraries, rows, df, frequent=frequent)


def test_documents(spark, libraries, small):
    rows = [tuple(r) for r in small.where("n_chars < 3000").select("doc_id", "text").collect()]
    check(spark, libraries, rows, small.where("n_chars < 3000"))


def test_tasks_that_hold_few_pairs(spark, libraries, small):
    rows = [tuple(r) for r in small.where("n_chars < 3000").select("doc_id", "text").collect()]
    check(spark, libraries, rows, small.where("n_chars < 3000"), held=10, frequent=200)


def test_tasks_that_remember_few_words(libraries, small, monkeypatch):
    monkeypatch.setattr(alignment, "_WORDS", 5)
    texts = [r.text for r in small.where("n_chars < 2000").limit(30).collect()]
    cutter = Cutter(open(A).read(), open(B, "rb").read())
    for text in texts:
        left, right = tokens(libraries, text)
        cut = cutter([text])
        assert (cut.n_a[0], cut.n_b[0]) == (len(left), len(right))


def test_words_and_units_are_the_libraries_encodings(libraries, small):
    cutter = Cutter(open(A).read(), open(B, "rb").read())
    texts = [t for t in TEXTS if t and "▁" not in t] + [r.text for r in small.limit(100).collect() if r.text]
    a, b = libraries
    for side, whole in ((cutter.a, lambda t: a.encode(" " + t, add_special_tokens=False).ids), (cutter.b, b.encode)):
        ids, at, kept = side([" " + t for t in texts])
        assert kept.all()
        assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:], strict=True)] == [whole(t) for t in texts]


def test_awkward(spark, libraries, awkward):
    check(spark, libraries, [(r.doc_id, r.text) for r in awkward.collect()], awkward)


def test_long_text(spark):
    (row,) = align(spark.createDataFrame([(1, "wort " * 200_000)], "doc_id long, text string"), A, B).documents.collect()
    assert row.n_links == row.n_groups > 100_000 and row.n_best == row.n_links


def test_empty(empty):
    found = align(empty, A, B)
    assert found.documents.collect() == [] and found.pairs.collect() == []
