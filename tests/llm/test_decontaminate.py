from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from monthlake.llm.decontaminate import decontaminate, items_digest, match_items, n_hit

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    windows: dict[tuple, set] = {}
    for item, text in items:
        own = words(text)
        if own:
            size = min(window, len(own))
            for i in range(len(own) - size + 1):
                windows.setdefault(tuple(own[i : i + size]), set()).update([] if item is None else [str(item)])
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if (names := windows.get(tuple(own[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(found), digest))
    return sorted(out, key=repr)


def ours(spark, docs, items, window=10, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = match_items(d, b, window, **settings).select(
        "doc_id", "n_words", n_hit().alias("h"), F.size("hit_items").alias("k"), items_digest(F.col("hit_items")).alias("x")
    )
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_random_texts_against_brute_force(spark):
    rng = random.Random(2)
    for window in (2, 4, 10):
        text = lambda n: " ".join(rng.choice("aa bb cc Dd é".split()) for _ in range(n))  # noqa: B023, E731
        items = [(i % 12, text(rng.randrange(0, 14))) for i in range(15)] + [(None, text(12)), (99, None), (98, "?!")]
        docs = [(i, text(rng.randrange(0, 40))) for i in range(60)] + [(None, text(30)), (70, None), (70, ""), (71, text(3000))]
        want = brute(docs, items, window)
        assert ours(spark, docs, items, window) == want
        # The same with several automata, one after the other.
        assert ours(spark, docs, items, window, bytes_per_automaton=60) == want


def test_driver_tables(spark, small):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [tuple(r) for r in small.select("doc_id", "text").collect()]
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    want = brute(docs, items, 10)
    assert ours(spark, docs, items) == want and any(row[2] for row in want)


def test_passages_are_cut_out(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame(
        [(1, f"Vorher, é. {passage.upper()}! " + "other words follow here " * 10, 300), (2, passage, 40), (3, "clean", 5), (4, None, None), (5, "", 0)],
        "doc_id long, text string, n_chars long",
    )
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate(docs, items).collect()}
    assert set(rows) == {1, 3, 4, 5}
    assert rows[1].text == "Vorher, é. ! " + "other words follow here " * 10 and rows[1].n_chars == len(rows[1].text)
    assert (rows[3].text, rows[3].n_chars, rows[4].text, rows[4].n_chars) == ("clean", 5, None, None)


def test_short_items_are_cut_out(spark):
    """An item of fewer words than the window goes from a long document too."""
    rest = "other words follow here " * 10
    docs = spark.createDataFrame([(1, f"before. What is the capital of France? {rest}"), (2, f"what is the capital {rest}")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "What is the capital of France?"), (2, " ".join(f"w{i}" for i in range(12)))], "item_id long, text string")
    for size in (8 << 20, 20):
        rows = {r.doc_id: r.text for r in decontaminate(docs, items, bytes_per_automaton=size).collect()}
        assert rows == {1: f"before. ? {rest}", 2: f"what is the capital {rest}"}


def test_one_part_of_items_at_a_time(spark, monkeypatch):
    """A part is made into its automaton before the next one is fetched."""
    from monthlake.llm import decontaminate as module

    events = []

    def parts(*_):
        for name in "ab":
            events.append("fetched")
            yield [(name, f"some words of {name}")]

    made = module.Matcher.__init__
    monkeypatch.setattr(module, "_automata", parts)
    monkeypatch.setattr(module.Matcher, "__init__", lambda self, *a: (events.append("made"), made(self, *a))[1])
    rows = ours(spark, [(1, "here are some words of a and some words of b")], [(1, "x")])
    assert events == ["fetched", "made"] * 2 and rows[0][2:4] == (8, 2)


def test_awkward(spark, awkward, empty):
    items = spark.createDataFrame([(1, "cat sat on the mat and then it left today maybe")], "item_id long, text string")
    rows = match_items(awkward, items).collect()
    assert len(rows) == awkward.count() and all(r.score == "kept" for r in rows)
    assert {r.doc_id: r.longest for r in rows}[9] == 0  # nine words are less than the window
    rows = match_items(awkward, items, window=9).collect()
    assert {r.doc_id: r.longest for r in rows}[9] == 9
    none = items.limit(0)
    assert match_items(awkward, none).where(n_hit() > 0).count() == 0
    assert match_items(empty, items).count() == match_items(empty, none).count() == 0
    assert decontaminate(awkward, items).columns == awkward.columns


def test_items_without_an_id_hit_words(spark):
    long, short = " ".join(f"w{i}" for i in range(14)), "only three words"
    docs = [(1, f"before {long} after"), (2, f"{short} here"), (3, "none of these")]
    items = [(None, long), (None, short), (7, long + " more"), (8, None), (9, "")]
    assert ours(spark, docs, items) == brute(docs, items, 10)
    assert [r[2] for r in ours(spark, docs, items[:2])] == [14, 3, 0]
