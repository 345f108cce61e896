from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from monthlake.llm.evidence import fit_logistic, sigmoid
from monthlake.llm.toxicity import THRESHOLD, restore, restore_texts, score_toxicity, train_toxicity

CLEAN = "the weather was mild and the people walked along the river for some hours "


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        word = ("stupid", "idiot", "trash")[i % 3]
        docs.append((i, CLEAN * (1 + i % 4) + (f"you {word} {word} " if bad else "") + f"t{i}"))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([*labels, (None, 1), (10**9, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    return train_toxicity(docs, labels, F.lit(True)), docs, labels


def test_disguised_words_are_restored(trained):
    model = trained[0]
    for token, word in {
        "1d10t": "idiot", "s t u p i d": "stupid", "s.t.u.p.i.d": "stupid", "stuuuupid": "stupid",
        "$tupid": "stupid", "tr@5h": "trash", "people": "people", "walked": "walked",
    }.items():
        assert restore(token, model.chars) == word


def test_scores(spark, trained):
    model, docs, labels = trained
    texts = {i: t for i, t in enumerate([CLEAN + "stupid", CLEAN + "st*upid 1d10t", CLEAN + "i d i o t", CLEAN, CLEAN * 50, "", None, "!!!"])}
    rows = score_toxicity(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()
    scores = {r.doc_id: r.score for r in rows}
    assert all(scores[i] >= THRESHOLD for i in (0, 1, 2)) and all(0 <= scores[i] < THRESHOLD for i in range(3, 8))


@pytest.mark.parametrize(
    "token",
    ["st*upid", "stu.pid", "idi-ot", "i-d-iot", "s-t-upid", "idiiot", "idioot", "st up id", "s   t   u   p   i   d", "s\tt\tu\tp\ti\td", "¡diot", "id¡ot", "¡ d ¡ o t", "tra\u0073\u0073h"],
)
def test_each_disguise_alone(trained, token):
    """Each reaches the lattice within a text without any other, and is restored."""
    import numpy as np

    from monthlake.llm.toxicity import Restorer

    data = np.frombuffer((CLEAN + token).encode(), np.uint8)
    (restored,) = Restorer(trained[0].chars).texts(data, np.array([0, len(data)]))
    assert {"stupid", "idiot", "trash"} & set(restored.split())


def test_spaced_letters_beyond_ascii(trained):
    import numpy as np

    from monthlake.llm.flat import LOWER
    from monthlake.llm.toxicity import _suspects

    for text in ("и д и о т", "blöödes"):
        data = LOWER[np.frombuffer(text.encode(), np.uint8)]
        assert [x.tolist() for x in _suspects(data, np.array([0, len(data)]))] == [[0], [0], [len(data)]]


def test_held_out(spark, trained):
    model, docs, labels = trained
    joined = score_toxicity(docs, model).join(labels.where("toxic IN (0, 1)"), "doc_id").collect()
    assert all((r.score >= THRESHOLD) == (r.toxic == 1) for r in joined)


def test_awkward(spark, awkward, empty, trained):
    model = trained[0]
    rows = score_toxicity(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 and r.n_words == 7 for r in rows)
    restored = restore_texts(awkward, model.chars)
    assert restored.count() == awkward.count()
    none = spark.createDataFrame([], "doc_id long, toxic int")
    unlearned = score_toxicity(awkward, train_toxicity(empty, none, F.lit(True))).select("score").distinct().collect()
    assert [r.score for r in unlearned] == [0.5]
    assert score_toxicity(empty, model).count() == 0


def test_logistic():
    import numpy as np

    x = np.linspace(-3, 3, 200)[:, None]
    w = fit_logistic(x, (x[:, 0] > 0.5).astype(float), ridge=1e-3)
    assert sigmoid(np.array([3.0]) @ w[:-1] + w[-1]) > 0.9 > 0.1 > sigmoid(np.array([-3.0]) @ w[:-1] + w[-1])


def test_rows_of_numbers_do_not_crawl():
    """1 MB of short numbers has nothing to decode, but for the words among them."""
    import random
    import time

    import numpy as np

    from monthlake.llm.toxicity import _suspects

    rng = random.Random(1)
    numbers = " ".join(str(rng.randrange(100)) for _ in range(350_000))
    text = (numbers + " s t u p i d " + numbers + " 1 d 1 0 t").encode()
    began = time.process_time()
    owner, start, end = _suspects(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert time.process_time() - began < 10
    found = [text[a:b].decode() for a, b in zip(start, end, strict=True)]
    # Single digits in a row stay, as long as a word may be; a hundredth of all this text.
    assert max(map(len, found)) < 120 and sum(map(len, found)) < len(text) / 100
    assert any("s t u p i d" in f for f in found) and any("1 d 1 0 t" in f for f in found)


def test_short_runs_of_digits_stay_suspects():
    import numpy as np

    from monthlake.llm.toxicity import _suspects

    text = b"so 5 7 0 9 1 0 they said"
    _, start, end = _suspects(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert any(b"5 7 0 9 1 0" in text[a:b] for a, b in zip(start, end, strict=True))
