from __future__ import annotations

import re
import textwrap

from monthlake.llm.licenses import LEAST_DICE, TEMPLATES, scan_licenses


def bigrams(text):
    words = re.sub(r"[^\w]|_", " ", text.lower()).split()
    return {(a, b) for a, b in zip(words, words[1:], strict=False)}


def brute(text):
    """Every unit against every template, without bounds."""
    text = text or ""
    units = text.split("\n") + re.split(r"\n[ \t\r]*\n", text) + [text]
    best = {}
    for unit in units:
        own = bigrams(unit)
        found = []
        for name, template in TEMPLATES:
            theirs = bigrams(template)
            if own:
                permille = 2000 * len(own & theirs) // (len(own) + len(theirs))
                found.append((-permille, name))
        if found and min(found)[0] <= -1000 * LEAST_DICE:
            permille, name = min(found)
            best[name] = max(best.get(name, 0), -permille)
    return sorted(best.items())


def ours(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = scan_licenses(df).orderBy("doc_id").collect()
    return [[(m.license, m.permille) for m in r.licenses] for r in rows]


def test_against_every_pair(spark, small):
    texts = [r.text for r in small.collect()]
    texts += [t for _, t in TEMPLATES] + [f"x\n{t.upper()}!\ny" for _, t in TEMPLATES]
    texts += ["Released under\nthe MIT\nLicense.\n\nother text", "under the MIT License", "Licensed under the", "", None, "MIT", "\n\n\n"]
    texts += ["released under the mit license " * 50, "Licensed under CC BY-NC 4.0. and then very much more text on the same line here"]
    got, want = ours(spark, texts), [brute(t) for t in texts]
    assert got == want
    assert sum(map(bool, got)) > 2 * len(TEMPLATES)


def test_bodies_and_headers(spark):
    """Whole licence files with title, owner and wrapped lines."""
    by_name = {name: text for name, text in TEMPLATES}  # the last of each is its longest
    for name, first in {"MIT": "Permission is hereby", "BSD-2-Clause": "Redistribution and", "BSD-3-Clause": "Redistribution and", "ISC": "Permission to use", "GPL-3.0": "This program is free", "AGPL-3.0": "This program is free"}.items():
        body = by_name[name]
        assert body.startswith(first)
        file = f"{name} License\n\nCopyright (c) 2020 Jane Doe\n\n" + "\n".join(textwrap.wrap(body, 72)) + "\n"
        ((found,),) = ours(spark, [file])
        assert found[0] == name


def test_units_are_named(spark):
    text = "first\n\nReleased under\nthe MIT License.\n\nlast"
    (row,) = scan_licenses(spark.createDataFrame([(text,)], "text string")).collect()
    (match,) = row.licenses
    assert (match.license, match.permille, match.kind, match.number) == ("MIT", 1000, "paragraph", 1)


def test_plan_has_no_shuffle_and_no_python(spark, small):
    plan = scan_licenses(small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_awkward(awkward, empty):
    rows = scan_licenses(awkward).collect()
    assert len(rows) == awkward.count() and all(list(r.licenses) == [] and r.n_words == 7 for r in rows)
    assert scan_licenses(empty).count() == 0
