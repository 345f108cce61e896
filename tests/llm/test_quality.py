from __future__ import annotations

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from monthlake.llm.evidence import fit_logistic, logit, sigmoid
from monthlake.llm.language import held_out, learnable
from monthlake.llm.quality import _PAGE, PAGE_BITS, _page, _page_counts, page_features, score_quality, train_quality


def test_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = train_quality(docs, labels, learnable())
    rows = score_quality(docs.where(held_out()), model).join(labels, "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert len(bad) >= 5 and sum(s >= 0.5 for s in good) >= 0.97 * len(good)
    assert sum(s < 0.5 for s in bad) >= 0.7 * len(bad)


def test_views_teach_each_other(spark):
    """Few labels; the page view learns from what the text view is sure of."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        words = [rng.choice("alpha beta gamma delta".split() if good else "zz## yy## xx## vv##".split()) for _ in range(60)]
        rows.append((i, " ".join(words), "en", "good.org" if good else "bad.org"))
        if i < 30:
            labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    scored = score_quality(docs, train_quality(docs, labels, F.lit(True), rounds=2)).collect()
    assert all((r.score > 0.5) == (r.doc_id % 3 > 0) for r in scored)
    assert all((r.score_page > 0.5) == (r.doc_id % 3 > 0) for r in scored)


def test_every_document_is_seen(spark):
    """Categories beyond a pool of 20,000 rows get evidence: each occurs in few of 30,000 rows."""
    rows = [(i, "alpha beta gamma delta " * 5 if i % 3 else "zz## yy## xx## vv## " * 5, "en", f"site{i % 3}-{i % 9999 // 3}") for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    table = train_quality(docs, labels, F.lit(True), rounds=1).page
    # Of each source the bucket, and which kinds of pages are in it.
    kinds: dict[int, set[bool]] = {}
    sources = docs.select("doc_id", "source", _page()[0].alias("bucket")).collect()
    for r in sources:
        kinds.setdefault(r.bucket, set()).add(r.doc_id % 3 > 0)
    assert len({r.source for r in sources}) == 9999 and len(kinds) > 9000
    base = table[next(b for b in range(1 << PAGE_BITS) if b not in kinds)]
    assert all((table[b] > base) == (True in own) for b, own in kinds.items() if len(own) == 1)


def test_many_sources_take_no_more(spark):
    """A million sources are counted in a table of the same size."""
    pages = spark.range(1_000_000).selectExpr("id", "'x' AS text", "'en' AS lang", "concat('https://site', id, '.org/') AS source")
    counts = _page_counts(pages.select(_page().alias("page"), F.lit(1).alias("label"), (F.col("id") % 2).cast("int").alias("half")))
    assert counts.shape == (2, len(_PAGE) << PAGE_BITS, 2)
    assert counts[:, : 1 << PAGE_BITS, 0].sum() == 1_000_000 and counts[..., 0].sum() == len(_PAGE) * 1_000_000


def _kind(c: str) -> str:
    for kind, pattern in (("digit", "[0-9]"), ("lower", "[a-z]"), ("upper", "[A-Z]"), ("stop", "[,.]"), ("far", "[^\x00-\x7f]")):
        if re.match(pattern, c):
            return kind
    return "other"


def _shape(word: str) -> tuple[str, ...]:
    kinds = [_kind(c) for c in word]
    return tuple(k for i, k in enumerate(kinds) if i == 0 or kinds[i - 1] != k)


def _shares(told: list[tuple[dict, int]], halves: tuple[int, ...]):
    """The share of good rows for a feature, by rows of these halves, in plain counts."""
    used = [(set(r["tokens"]) | set(r["shapes"]), label) for r, label in told if r["half"] in halves]
    base = (sum(label for _, label in used) + 1) / (len(used) + 2)

    def share(feature) -> float:
        own = [label for features, label in used if feature in features]
        return float(np.float16((sum(own) + 5 * base) / (len(own) + 5)))

    return share


def _text_facts(row: dict, share) -> list[float]:
    weight = {f: float(logit(np.float64(min(max(share(f), 1e-3), 1 - 1e-3)))) for f in set(row["tokens"]) | set(row["shapes"])}
    n = max(len(row["tokens"]), 1)
    against = sum(weight[f] < 0 for f in row["tokens"] + row["shapes"])
    means = [sum(weight[f] for f in row[kind]) / n for kind in ("tokens", "shapes")]
    return [*means, against / n, math.log1p(len(row["tokens"])) / 5, len(set(row["tokens"])) / n]


def _page_facts(row: dict, told: list[tuple[dict, int]], halves: tuple[int, ...]) -> list[float]:
    used = [(r, label) for r, label in told if r["half"] in halves]
    base = (sum(label for _, label in used) + 1) / (len(used) + 2)
    out = []
    for name in _PAGE:
        own = [label for r, label in used if r[name] == row[name]]
        out.append(float(logit(np.float64((sum(own) + 5 * base) / (len(own) + 5)))))
    return out


def _probability(facts: list[float], weights: np.ndarray) -> float:
    return float(sigmoid(np.dot(facts, weights[:-1]) + weights[-1]))


def _sure(p: float) -> int:
    return 1 if p >= 0.95 else 0 if 1 - p >= 0.95 else -1


def _brute_force(rows: list[dict], labels: dict[int, int], rounds: int) -> dict[int, tuple[float, float, float]]:
    """Scores of all rows by co-training in plain Python, without hashing and without Spark."""
    sample = [(r, labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels]
    others = [r for r in rows if r["doc_id"] not in labels]
    truth = np.array([label for _, label in sample], float)
    told_text, told_page = sample, sample
    for number in range(rounds + 1):
        shares = {halves: _shares(told_text, halves) for halves in ((0,), (1,), (0, 1))}
        facts = np.array([_text_facts(r, shares[(1 - r["half"],)]) for r, _ in sample])
        text_weights = fit_logistic(facts, truth)
        page = np.array([_page_facts(r, told_page, (1 - r["half"],)) for r, _ in sample])
        page_weights = fit_logistic(page, truth)
        p_text = {r["doc_id"]: _probability(_text_facts(r, shares[(0, 1)]), text_weights) for r in rows}
        p_page = {r["doc_id"]: _probability(_page_facts(r, told_page, (0, 1)), page_weights) for r in rows}
        if number < rounds:
            told_text, told_page = (
                sample + [(r, _sure(p[r["doc_id"]])) for r in others if _sure(p[r["doc_id"]]) >= 0] for p in (p_page, p_text)
            )
            assert len(told_text) > len(sample) and len(told_page) > len(sample)

    def views(*p: float) -> list[float]:
        return [float(logit(np.float64(min(max(x, 1e-6), 1 - 1e-6)))) for x in p]

    joint = fit_logistic(
        np.array([views(float(a), float(b)) for a, b in zip(sigmoid(facts @ text_weights[:-1] + text_weights[-1]), sigmoid(page @ page_weights[:-1] + page_weights[-1]), strict=True)]),
        truth,
    )
    return {i: (p_text[i], p_page[i], _probability(views(p_text[i], p_page[i]), joint)) for i in p_text}


def test_against_brute_force(spark):
    """Counts, pseudo-labels and scores of 200 rows; some words and sites belong to both kinds."""
    rng = random.Random(7)
    good_words, bad_words, any_words = "Alpha beta Gamma,delta 12.5 épsilon".split(), "zz## YY99 xx-- Vv@@".split(), "the of and 7".split()
    rows, labels = [], {}
    for i in range(200):
        good = rng.random() < 0.6
        own, other = (good_words, bad_words) if good else (bad_words, good_words)
        words = [rng.choice(rng.choices([own, other, any_words], [6, rng.choice([0, 0, 0, 1]), 3])[0]) for _ in range(rng.randint(3, 40))]
        source = rng.choice([f"good{i % 3}.org" if good else f"bad{i % 3}.org", "both.org"])
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words), rng.choice(["en", "de", None]), source))
        if i < 60:
            labels[i] = int(good)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")
    plain = [r.asDict() for r in docs.select("doc_id", "text", half, *(page_features()[k].alias(k) for k in _PAGE)).collect()]
    for r in plain:
        words = r["text"].split()
        r["tokens"] = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
        r["shapes"] = [_shape(w) for w in words]
    wanted = _brute_force(plain, labels, 2)
    known = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    scored = score_quality(docs, train_quality(docs, known, F.lit(True), rounds=2)).collect()
    assert len(scored) == 200
    assert all(abs(a - b) < 1e-3 for r in scored for a, b in zip((r.score_text, r.score_page, r.score), wanted[r.doc_id], strict=True))


def test_awkward(spark, awkward, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (2, None), (3, 9)], "doc_id long, quality int")
    for labels in (none, some):
        model = train_quality(awkward, labels, F.lit(True), rounds=1)
        rows = score_quality(awkward, model).collect()
        assert len(rows) == awkward.count() and all(0 <= r.score <= 1 and r.n_words == 7 for r in rows)
        assert score_quality(empty, model).count() == 0
    assert score_quality(awkward, train_quality(empty, none, F.lit(True), rounds=1)).count() == awkward.count()
