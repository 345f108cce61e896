from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from monthlake.llm import merkle, registry

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    doc_id, source, lang, n_chars = row[:4]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def rolled(hashes, fan_out=3):
    """The last node, and for each of ``hashes`` its steps (left, right)."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p // fan_out * fan_out :][:fan_out]
            paths[i].append(("".join(run[: p % fan_out]), "".join(run[p % fan_out + 1 :])))
            at[i] = p // fan_out
        level = [h(*level[i : i + fan_out]) for i in range(0, len(level), fan_out)]
    return level[0], paths


def brute(rows, fan_out=3):
    """Rows (doc_id, source, lang, n_chars, text) as the registered query answers them."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    found = {}
    for source in sources:
        own = sorted((r for r in rows if r[1] == source), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        found[source] = own, *rolled([leaf_of(r, r[4]) for r in own], fan_out)
    root, above = rolled([found[s][1] for s in sources], fan_out)
    out = []
    for source, over in zip(sources, above, strict=True):
        own, subroot, paths = found[source]
        for row, path in zip(own, paths, strict=True):
            tampered = row[4]
            if tampered is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                tampered = tampered.replace("\n", "")
            folded = leaf_of(row, tampered)
            for left, right in path + over:
                folded = h(left, folded, right)
            proof = h(*(left + right for left, right in path + over))
            out.append((row[0], leaf_of(row, row[4]), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def ours(df, **settings):
    found = merkle.manifest(df, COLUMNS, "source", "doc_id", claimed=merkle.without_breaks(), claims="text", **settings)
    found = found.select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")), merkle.folded(F.col("claimed_leaf"), F.col("path")).alias("folded"), "root"
    )
    return sorted(((*r[:6], r[5] == r[6]) for r in found.collect()), key=str)


def rows_of(df):
    return [tuple(r) for r in df.select(COLUMNS).collect()]


def test_as_by_hand(small):
    assert ours(small) == brute(rows_of(small))


@pytest.mark.parametrize("digits", [1, 2])
def test_many_passes(small, digits):
    """Blocks of a few leaves: several passes over the same trees give the same manifest."""
    assert ours(small, digits=digits) == brute(rows_of(small))


def test_other_fan_out(small):
    assert ours(small, fan_out=2, digits=3) == brute(rows_of(small), 2)


def test_order_and_layout_do_not_matter(spark, small):
    assert ours(small.repartition(7).orderBy(F.desc("text"))) == ours(small.coalesce(1))


def test_every_size_of_a_source(spark):
    rows = [(i, f"s{n}", "en", None, f"line {i}\nof {n}") for n in range(1, 32) for i in range(n)]
    assert ours(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"), digits=2) == brute(rows)


def test_awkward(awkward):
    """Nulls in every column, repeated rows and ids, long texts; one null source among others."""
    found = ours(awkward.selectExpr("*", "1 AS rank", "2 AS n", "3 AS key", "4 AS hash", "5 AS kids"))
    assert found == brute(rows_of(awkward))
    assert len(found) == awkward.count()


def test_one_row(spark, awkward):
    one = awkward.where("doc_id = 8")
    (row,) = ours(one)
    assert row[1] == row[2] == row[3] == row[5] and row[4] == h() and row[6]


def test_empty(empty):
    assert ours(empty) == []


def test_a_change_of_any_field_is_seen(small):
    for name, value in (("text", F.concat("text", F.lit("."))), ("n_chars", F.col("n_chars") + 1), ("lang", F.lit(None).cast("string"))):
        found = merkle.manifest(small, COLUMNS, "source", "doc_id", claimed=value, claims=name)
        bad = found.where(merkle.folded(F.col("claimed_leaf"), F.col("path")) == F.col("root")).where(F.col("claimed_leaf") != F.col("leaf"))
        assert bad.count() == 0
        assert found.where(F.col("claimed_leaf") != F.col("leaf")).count() > 0


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    df = registry.op12_merkle_manifest(spark, folder)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        expected = db.execute(f"SELECT {', '.join(df.columns)} FROM ({merkle.oracle()})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(expected, key=str)


def test_no_join_in_the_proofs(small):
    plan = merkle.manifest(small, COLUMNS, "source", "doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
