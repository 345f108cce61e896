from __future__ import annotations

import random
import re

import pytest

from monthlake.llm.jaccard import keep_first_of_groups, similar_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    own = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(own) < 5:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def brute(docs):
    sets = [(doc, shingle_set(text)) for doc, text in docs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            both = len(a & b)
            if both and 100 * both >= 80 * len(a | b):
                parent[find(i)] = find(j)
    groups: dict[int, list] = {}
    for i, (doc, _) in enumerate(sets):
        groups.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, own) in enumerate(sets):
        ids = [d for d in groups[find(i)] if d is not None] if own else []
        out.append((doc, len(own), min(ids) if ids else doc))
    return sorted(out, key=repr)


def ours(spark, docs, **settings):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = similar_documents(df, **settings).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def crowd():
    """Exact and near copies, chains of edits, a passage in many texts, and awkward rows."""
    rng = random.Random(5)
    new = lambda n: [f"w{rng.randrange(10**5)}" for _ in range(n)]
    texts = [" ".join(new(rng.randrange(0, 60))) for _ in range(40)]
    for size in (8, 40, 200):
        base = new(size)
        texts += [" ".join(base)] * 5 + [edited(rng, base, rng.randrange(0, max(2, size // 20))) for _ in range(25)]
    chain = new(120)
    for _ in range(20):
        chain = edited(rng, chain, 2).split()
        texts.append(" ".join(chain))
    passage = " ".join(new(30))
    texts += [f"{passage} {' '.join(new(rng.randrange(0, 15)))}" for _ in range(40)]
    rng.shuffle(texts)
    docs = list(enumerate(texts, start=10))
    return docs + [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (None, texts[0]), (None, "alone here"), (12, "other text of it")]


def test_against_brute_force(spark, crowd):
    want = brute(crowd)
    assert len({c for *_, c in want}) < len(want) - 60
    assert ours(spark, crowd) == want


def test_many_small_fragments_give_the_same(spark, crowd):
    assert ours(spark, crowd, shingles_per_fragment=500) == brute(crowd)


def test_driver_table(spark, small):
    docs = [tuple(r) for r in small.select("doc_id", "text").collect()]
    assert ours(spark, docs) == brute(docs)


def test_empty(spark, empty):
    assert similar_documents(empty).count() == 0


def test_one_of_each_group_stays(spark, awkward):
    kept = keep_first_of_groups(awkward)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == awkward.columns
    assert 9 not in ids and ids.count(1) == 2 and ids.count(None) == 2 and {2, 3, 4, 5, 6, 7, 8} <= set(ids)


def test_copies_are_told_apart_by_text(spark):
    """An id with a copy and a text of its own keeps the latter; rows without an id go if they are copies."""
    text = " ".join(f"w{i}" for i in range(40))
    near = text + " end"
    rows = [(1, text), (5, text), (5, "a text that stands alone here"), (None, near), (None, "another one without any id"), (7, ""), (7, None)]
    kept = keep_first_of_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[2], *rows[4:]], key=str)


def test_copies_without_any_id(spark):
    text = " ".join(f"w{i}" for i in range(40))
    kept = keep_first_of_groups(spark.createDataFrame([(None, text), (None, text + " end"), (None, "x")], "doc_id long, text string"))
    assert kept.count() == 2
