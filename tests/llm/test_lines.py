from __future__ import annotations

import random

import pytest

from monthlake.llm.lines import SHINGLE, dedup_lines, keep_new_lines


def runs(line):
    own = line.strip().lower()
    return {own[i : i + SHINGLE] for i in range(max(1, len(own) - SHINGLE + 1))}


def brute(docs, least=0.8):
    """All pairs of lines; the first of each component stays."""
    places = [(doc, at, line) for doc, text in docs for at, line in enumerate((text or "").split("\n")) if line.strip()]
    distinct = sorted({line.strip().lower() for *_, line in places})
    sets = [runs(line) for line in distinct]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= least * len(a | sets[j]):
                parent[find(i)] = find(j)
    number = {line: find(i) for i, line in enumerate(distinct)}
    seen, gone = set(), set()
    for doc, at, line in sorted(places, key=lambda p: p[:2]):
        component = number[line.strip().lower()]
        if component in seen:
            gone.add((doc, at))
        seen.add(component)
    return {doc: None if text is None else "\n".join(x for at, x in enumerate(text.split("\n")) if (doc, at) not in gone) for doc, text in docs}


@pytest.fixture(scope="module")
def crowd():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n))
    base = [line(rng.randrange(20, 60)) for _ in range(6)]

    def near(text):
        own = text.split()
        own[rng.randrange(len(own))] = word()
        return " ".join(own)

    common = line(12)
    docs = []
    for i in range(80):
        own = [line(rng.randrange(1, 40)) for _ in range(rng.randrange(0, 5))]
        own += [near(rng.choice(base)) for _ in range(2)] + [common.upper()] * (i % 2) + [" " + common] * (i % 3) + [""]
        rng.shuffle(own)
        docs.append((i, "\n".join(own)))
    return docs + [(100, None), (101, ""), (102, "\n \n"), (103, "ab"), (104, "AB"), (105, "日本語 é😀 " * 30), (106, "日本語 é😀 " * 30)]


def test_against_brute_force(spark, crowd):
    rows = dedup_lines(spark.createDataFrame(crowd, "doc_id long, text string")).collect()
    got, want = {r.doc_id: r.text for r in rows}, brute(crowd)
    assert got.keys() == want.keys()
    # Banding finds a pair of just 0.8 with probability 0.98; these are mostly above.
    assert sum(got[d] != want[d] for d in want) <= 1
    assert sum(want[d] != t for d, t in crowd) > 70
    for r in rows:
        assert r.n_kept == sum(bool(x.strip()) for x in (r.text or "").split("\n"))


def test_one_edit_in_short_lines(spark):
    """Lines of 30 to 80 characters with one character replaced: at the end below 40, else inside."""
    rng = random.Random(8)
    docs = []
    for n in range(30, 81):
        line = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
        at = rng.randrange(4, n - 4) if n >= 40 else n - 1
        docs += [(len(docs), line), (len(docs) + 1, line[:at] + "7" + line[at + 1 :])]
    kept = {r.doc_id for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).where("n_kept = 1").collect()}
    assert {d for d, _ in docs if d % 2 == 0} <= kept
    # Banding misses one pair in fifty at 0.8, fewer above.
    assert sum(d % 2 for d in kept) <= 3


def test_native(spark, small):
    plan = dedup_lines(small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_driver_table(spark, small):
    """Exact: what is kept are different lines, and every line is kept somewhere or like a kept one."""
    rows = dedup_lines(small).collect()
    kept = [x.strip().lower() for r in rows for x in (r.text or "").split("\n") if x.strip()]
    before = {x.strip().lower() for r in small.collect() for x in (r.text or "").split("\n") if x.strip()}
    assert len(kept) == len(set(kept)) and set(kept) <= before
    lost = before - set(kept)
    sets = [runs(x) for x in kept]
    for x in lost:
        assert max(len(runs(x) & s) / len(runs(x) | s) for s in sets) > 0.5


def test_awkward(awkward, empty):
    rows = dedup_lines(awkward).collect()
    assert len(rows) == awkward.count() and all(r.score == "kept" for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [r.text for r in by_id[1]] == ["the cat sat on the mat and then it left"] * 2
    assert [(r.text, r.n_kept) for r in by_id[9]] == [("", 0)]
    assert [(r.text, r.n_lines) for r in by_id[2]] == [(None, 0)]
    assert [(r.text, r.n_lines) for r in by_id[4]] == [("   \n\t\n ", 0)]
    assert dedup_lines(empty).count() == 0
    kept = keep_new_lines(awkward)
    assert kept.columns == awkward.columns and 9 not in {r.doc_id for r in kept.collect()}


def test_unlike_lines_in_one_bucket_give_few_pairs(spark):
    """3,000 lines of 3,000 components in one bucket: a bounded number of pairs each, not 4.5 million."""
    from pyspark.sql import functions as F

    from monthlake.llm.lines import CUTS, FEW, across
    from monthlake.llm.scratch import Scratch

    members = spark.range(3000).select(
        F.lit(7).cast("long").alias("bucket"), F.col("id").alias("node"), F.array(F.xxhash64("id"), F.xxhash64("id", F.lit(1))).alias("sketch"), F.col("id").alias("root")
    )
    n = across(members, F.lit(True), 2, Scratch(spark)).count()
    assert 3000 < n <= 3000 * CUTS * FEW / 2


def test_text_of_many_lines(spark):
    """40,000 unlike lines, each there twice, in one text."""
    rng = random.Random(4)
    once = [f"{rng.getrandbits(160):040x}" for _ in range(40_000)]
    text = "\n".join(line for own in once for line in (own, f"  {own.upper()}"))
    (row,) = dedup_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert (row.n_lines, row.n_kept, row.text) == (80_000, 40_000, "\n".join(once))


def test_large_bucket_of_alike_sketches_gives_every_pair(spark):
    """60 lines of 60 components, alike in every sketch bit, in one bucket: the cuts cannot part
    them, so pairing with the ends alone leaves most pairs out; the exact pass gives all 1,770."""
    from pyspark.sql import functions as F

    from monthlake.llm.lines import across, rest
    from monthlake.llm.scratch import Scratch

    members = spark.range(60).select(
        F.lit(7).cast("long").alias("bucket"), F.col("id").alias("node"), F.array(F.lit(5).cast("long"), F.lit(9).cast("long")).alias("sketch"), F.col("id").alias("root")
    )
    every = {(a, b) for a in range(60) for b in range(a + 1, 60)}
    assert {(r.a, r.b) for r in across(members, F.lit(True), 2, Scratch(spark)).collect()} < every
    found = [(r.a, r.b) for r in rest(members, F.lit(True), Scratch(spark), block=7).collect()]
    assert len(found) == len(every) and set(found) == every
    # Members of one component are joined already.
    joined = members.withColumn("root", F.when(F.col("node") < 30, F.lit(0)).otherwise(F.col("node")))
    found = {(r.a, r.b) for r in rest(joined, F.lit(True), Scratch(spark), block=7).collect()}
    assert found == {(a, b) for a, b in every if b >= 30}


def test_exact_pass_copies_a_bucket_of_two_thousand_once(spark):
    """With the default blocks, a bucket of 2,000 lines is one block: each line stands once, not
    once for every block of the bucket, so what the exact pass moves grows far slower than its square."""
    from pyspark.sql import functions as F

    from monthlake.llm.lines import BLOCK, _blocked

    members = spark.range(2000).select(F.lit(7).cast("long").alias("bucket"), F.col("id").alias("node"), F.array(F.lit(5).cast("long")).alias("sketch"), F.col("id").alias("root"))
    dealt = _blocked(members.withColumn("size", F.lit(2000).cast("long")), BLOCK)
    assert dealt.count() == 2000


def test_buckets_store_only_what_later_steps_read(spark):
    """A small bucket leaves its candidates, each once; a large one its lines, paired with its ends."""
    from pyspark.sql import functions as F

    from monthlake.llm.lines import AT_ONCE, _shared
    from monthlake.llm.scratch import Scratch

    none, all_bits = [0, 0], [0x5555555555555555] * 2
    unlike = [(n, none if n % 2 else all_bits, [1]) for n in (0, 1)]
    alike = [(n, none, [2, 100 + n]) for n in (10, 11, 12)]
    many = [(n, none, [3]) for n in range(20, 20 + AT_ONCE + 1)]
    alone = [(40, none, [4]), (41, none, [])]
    nodes = spark.createDataFrame(unlike + alike + many + alone, "node long, sketch array<long>, bands array<long>")
    rows = _shared(nodes, 2, 18, Scratch(spark)).collect()
    small = [r for r in rows if r.bucket is None]
    assert sorted((r.node, sorted(r.near)) for r in small) == [(11, [10]), (12, [10, 11])]
    large = {r.node: r for r in rows if r.bucket is not None}
    assert set(large) == {n for n, *_ in many} and {r.size for r in large.values()} == {AT_ONCE + 1}
    assert set(large[24].near) == {20, 20 + AT_ONCE} and large[24].sketch == none


def test_filter_comes_before_the_shuffle(spark):
    """Rows whose key is surely not wanted are left out before the join, not after it."""
    from pyspark.sql import functions as F

    from monthlake.llm.lines import _maybe

    rows = spark.range(100_000).select(F.xxhash64("id").alias("key"), "id")
    wanted = rows.where("id < 50").select("key")
    assert {r.id for r in _maybe(rows, wanted, "key").join(wanted, "key").collect()} == set(range(50))
    assert _maybe(rows, wanted, "key").count() < 200


def test_documents_that_lose_no_line_are_not_shuffled(spark):
    """They stand in a branch of their own, without a join with the lines that go; extra columns and null ids stay."""
    rng = random.Random(9)
    docs = [(i, f"{rng.getrandbits(160):040x}", i) for i in range(300)] + [(400, "twice", 1), (401, "twice\nonce", 2), (None, "twice", 3), (402, None, 4)]
    df = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string, extra int"))
    union = df._jdf.queryExecution().optimizedPlan().toString().split("Union", 1)
    assert len(union) == 2
    rows = df.collect()
    assert df.columns == ["doc_id", "text", "extra", "n_lines", "n_kept"] and len(rows) == len(docs)
    by_id = {r.doc_id: (r.text, r.n_lines, r.n_kept) for r in rows}
    assert by_id[400] == ("twice", 1, 1) and by_id[401] == ("once", 2, 1) and by_id[None] == ("", 1, 0) and by_id[402] == (None, 0, 0)
    assert all(by_id[i] == (text, 1, 1) for i, text, _ in docs[:300])


def test_runs_are_those_of_the_line(spark):
    """Distinct runs of UTF-16 units, with surrogates and lines shorter than a run."""
    from pyspark.sql import functions as F

    from monthlake.llm.lines import _runs

    lines = ["ab", "abcd", "aaaaaaaa", "日本語 é😀 ok 日本語 é😀", "x" * 3000 + "yz"]
    got = spark.createDataFrame([(x,) for x in lines], "line string").select("line", F.size(_runs("line", SHINGLE)).alias("n")).collect()

    def units(x):
        own = x.encode("utf-16-be")
        return len({own[i : i + 2 * SHINGLE] for i in range(0, max(1, len(own) - 2 * SHINGLE + 1), 2)})

    assert {r.line: r.n for r in got} == {x: units(x) for x in lines}
