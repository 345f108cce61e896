"""Merkle manifest of a table: a root, and a proof for every row (operator 12).

A row's leaf is the SHA-256 of its fields. Within a group the leaves ascend by an order
column; while a group has several nodes, every ``fan_out`` consecutive ones become their
hash, and the last run may be shorter. What remains is the group's subroot; the subroots,
in the order of the groups, give the root in the same way.

The rollup, in DataFrame functions only:

1. Ranks: leaves are range-partitioned and sorted; counts per group and partition turn
   places in partitions into ranks. No group is sorted or numbered in one task.
2. Blocks: the rank's lowest ``digits`` digits (to the base ``fan_out``) are columns, what
   is above them is the block. After one exchange by block the digits are grouped away one
   after the other; each step collects at most ``fan_out`` child structs, which nest theirs.
   A block nests at most ``fan_out ** digits`` rows, whatever the group's size.
3. Blocks' hashes are the nodes of the next pass, until every group has one node; the
   subroots are ranked and rolled up as one more group.
4. Proofs: on the way down, a block's nested structs and the path above it come together
   in one grouping; a transform over the nested structs lists every row with its
   siblings, level by level, and an explode emits them. There is no join.

A step of a path has the hashes to the left and to the right of the node. A level where a
group has one node only has no step; a run of one has a step without siblings.

Defined results: fields that are null count as ``-``. A null group is a group of its own and
comes first; null order values come first; ties follow the leaves' hashes, so the manifest
depends on the rows alone, not on their order or layout. Equal rows are leaves of their own
with one proof each; a table without rows gives none. Texts count whole. Columns that are
not named are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthlake.llm.scratch import Scratch

FAN_OUT, DIGITS = 3, 6
_STEPS = "array<struct<left: string, right: string>>"
_PLACE_BITS = 33  # of monotonically_increasing_id, below the number of the partition


def digest(parts: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of strings one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: its UTF-8 length and itself, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _ranked(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """Adds ``rank`` (from 0) within ``key`` by (order, hash) and the key's count ``n``; and the greatest n."""
    rows = scratch.put(rows.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    places = [F.col("key").asc_nulls_first(), F.col("order").asc_nulls_first(), F.col("hash"), F.col("tie")]
    ordered = rows.repartitionByRange(*places).sortWithinPartitions(*places).drop("tie")
    ordered = scratch.put(ordered.withColumn("seq", F.monotonically_increasing_id()), "ordered")
    scratch.drop(rows)
    ordered = ordered.withColumn("part", F.shiftright("seq", _PLACE_BITS))
    counts = ordered.groupBy("key", "part").agg(F.min("seq").alias("first"), F.count("*").alias("n_part"))
    by_part = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.select(
        F.col("key").alias("in_key"),
        F.col("part").alias("in_part"),
        (F.sum("n_part").over(by_part) - F.col("n_part") - F.col("first")).alias("shift"),
        F.sum("n_part").over(Window.partitionBy("key")).alias("n"),
    )
    counts = scratch.put(counts, "counts")
    most = counts.agg(F.max("n")).first()[0] or 0
    here = F.col("key").eqNullSafe(F.col("in_key")) & (F.col("part") == F.col("in_part"))
    return ordered.join(counts, here).select("key", "row", "hash", (F.col("seq") + F.col("shift")).alias("rank"), "n"), most


def _rolled(nodes: DataFrame, fan_out: int, digits: int) -> DataFrame:
    """(key, n, block, hash, kids): each block's hash and its nodes, nested level by level."""
    names = [f"d{j}" for j in reversed(range(digits))]
    digit = {f"d{j}": F.expr(f"cast(rank div {fan_out**j} % {fan_out} as int)") for j in range(digits)}
    level = nodes.select("key", "n", F.expr(f"rank div {fan_out**digits}").alias("block"), "hash", "row", *(c.alias(d) for d, c in digit.items()))
    level = level.repartition("key", "block")
    child = ("hash", "row")
    for j in range(digits):
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"d{j}").alias("d"), *child)))
        grouped = level.groupBy("key", "n", "block", *names[: digits - 1 - j]).agg(kids.alias("kids"))
        several = F.col("n") > fan_out**j
        level = grouped.withColumn(
            "hash", F.when(several, F.sha2(F.array_join("kids.hash", ""), 256)).otherwise(F.col("kids")[0]["hash"])
        )
        child = ("hash", "kids")
    return level.select("key", "n", "block", "hash", "kids")


def _step(kids: Column, at: Column) -> Column:
    """The siblings of a child, to its left and to its right."""
    hashes = kids["hash"]
    left, right = F.slice(hashes, F.lit(1), at), F.slice(hashes, at + 2, F.size(hashes))
    return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))


def _listed(kids: Column, path: Column, j: int, n: Column, fan_out: int) -> Column:
    """All nodes below ``kids`` with the path of each, from the node up."""

    def below(kid: Column, at: Column) -> Column:
        step = F.when(n > fan_out**j, F.array(_step(kids, at))).otherwise(F.array().cast(_STEPS))
        upward = F.concat(step, path)
        if j == 0:
            return F.struct(kid["row"].alias("row"), kid["hash"].alias("hash"), upward.alias("path"))
        return _listed(kid["kids"], upward, j - 1, n, fan_out)

    found = F.transform(kids, below)
    return found if j == 0 else F.flatten(found)


def _proofs(nodes: DataFrame, most: int, above: Callable[[DataFrame], DataFrame], fan_out: int, digits: int, scratch: Scratch) -> DataFrame:
    """(key, row, hash, path, subroot, root) of every node (key, rank, n, hash, row).

    ``most`` is the greatest n. ``above`` gives (key, path, subroot, root) for each key's
    last node (key, hash).
    """
    trees = scratch.put(_rolled(nodes, fan_out, digits), "trees")
    size = fan_out**digits
    if most > size:
        upper = trees.select("key", F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("block").alias("rank"), "hash", F.col("block").alias("row"))
        upper = _proofs(upper, -(-most // size), above, fan_out, digits, scratch).withColumnRenamed("row", "block")
    else:
        upper = above(trees.select("key", "hash")).withColumn("block", F.lit(0).cast("long"))
    kinds = dict(trees.dtypes)
    none = {"kids": kinds["kids"], "n": "long", "path": _STEPS, "subroot": "string", "root": "string"}

    def side(frame: DataFrame, *has: str) -> DataFrame:
        return frame.select("key", "block", *(name if name in has else F.lit(None).cast(kind).alias(name) for name, kind in none.items()))

    together = side(trees, "kids", "n").unionByName(side(upper, "path", "subroot", "root"))
    together = together.groupBy("key", "block").agg(*(F.first(name, ignorenulls=True).alias(name) for name in none))
    listed = _listed(F.col("kids"), F.col("path"), digits - 1, F.col("n"), fan_out)
    return together.select("key", "subroot", "root", F.explode(listed).alias("x")).select("key", "x.row", "x.hash", "x.path", "subroot", "root")


def manifest(
    rows: DataFrame,
    fields: Sequence[str],
    group: str,
    order: str,
    claimed: Column | None = None,
    claims: str | None = None,
    fan_out: int = FAN_OUT,
    digits: int = DIGITS,
) -> DataFrame:
    """(``order``, ``group``, leaf, claimed_leaf, path, subroot, root) of every row.

    ``claimed`` may be another value of the field ``claims``, which gives another leaf to
    check against the root; without it both leaves are the same.
    """
    scratch = Scratch(rows.sparkSession)
    columns = {name: F.col(name) for name in fields}
    leaf = digest([field(c) for c in columns.values()])
    other = leaf if claimed is None else digest([field(c) for c in (columns | {claims: claimed}).values()])
    leaves = rows.select(F.col(group).alias("key"), F.col(order).alias("order"), leaf.alias("hash"), other.alias("other"))
    leaves = leaves.select("key", "order", "hash", F.struct("order", F.when(F.col("other") != F.col("hash"), F.col("other")).alias("other")).alias("row"))
    ranked, most = _ranked(leaves, scratch)

    def root(last: DataFrame) -> DataFrame:
        return last.select("key", F.array().cast(_STEPS).alias("path"), F.col("hash").alias("subroot"), F.col("hash").alias("root"))

    def over_groups(subroots: DataFrame) -> DataFrame:
        several = subroots.select(F.lit(0).alias("key"), F.col("key").alias("order"), "hash", F.struct(F.col("key").alias("group")).alias("row"))
        of_groups, n = _ranked(several, scratch)
        proved = _proofs(of_groups, n, root, fan_out, digits, scratch)
        return scratch.put(proved.select(F.col("row.group").alias("key"), "path", F.col("hash").alias("subroot"), "root"), "groups")

    proved = _proofs(ranked, most, over_groups, fan_out, digits, scratch)
    return proved.select(
        F.col("row.order").alias(order),
        F.col("key").alias(group),
        F.col("hash").alias("leaf"),
        F.coalesce("row.other", "hash").alias("claimed_leaf"),
        "path",
        "subroot",
        "root",
    )


def siblings_digest(path: Column) -> Column:
    """The hash of all siblings on a path, from the leaf to the root and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def without_breaks() -> Column:
    """``text`` as the registered query tampers with it: line breaks go where the crc32 of doc_id is even."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def _levels(table: str, prefix: str, depth: int) -> str:
    """SQL of the levels 1 … depth above ``prefix``0 (key, rank, n, h); a level of one node is handed on."""
    out = ""
    for j in range(depth):
        out += f"""
        {prefix}{j + 1} AS (SELECT key, rank // 3 AS rank, any_value((n + 2) // 3) AS n,
          CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY rank)) ELSE any_value(h) END AS h
          FROM {prefix}{j} GROUP BY key, rank // 3),
        {prefix}s{j} AS (SELECT key, rank,
          CASE WHEN n > 1 THEN coalesce(string_agg(h, '' ORDER BY rank) OVER (PARTITION BY key, rank // 3 ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
          CASE WHEN n > 1 THEN coalesce(string_agg(h, '' ORDER BY rank) OVER (PARTITION BY key, rank // 3 ORDER BY rank ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r
          FROM {prefix}{j}),"""
    return out


def _folds(prefix: str, start: str, depth: int) -> str:
    """SQL that takes ``start`` (…, key, rank, cur, proof) through the steps of each level."""
    out, last = "", start
    for j in range(depth):
        out += f"""
        {prefix}f{j} AS (SELECT f.* REPLACE (f.rank // 3 AS rank,
          CASE WHEN s.l IS NULL THEN f.cur ELSE sha256(s.l || f.cur || s.r) END AS cur,
          f.proof || coalesce(s.l || s.r, '') AS proof)
          FROM {last} f JOIN {prefix}s{j} s ON f.key IS NOT DISTINCT FROM s.key AND f.rank = s.rank),"""
        last = f"{prefix}f{j}"
    return out


def oracle(leaf_levels: int = 18, group_levels: int = 10) -> str:
    """The registered query as SQL for up to 3^18 rows in 3^10 sources; levels are written out one by one."""
    sql_field = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-')"

    def leaf(text: str) -> str:
        parts = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(sql_field(f"({p})") for p in parts) + ")"

    # crc32 of the decimal digits: each byte, then eight steps (marked -1) of the reflected polynomial.
    bits = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    codes = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, x: {bits}), 4294967295)"
    return f"""
        WITH d AS (SELECT doc_id, source AS key, {leaf("text")} AS leaf,
            {leaf(f"CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS claimed
          FROM documents),
        a0 AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
            count(*) OVER (PARTITION BY key) AS n, leaf AS h FROM d),
        {_levels("a", "a", leaf_levels)}
        b0 AS (SELECT 0 AS key, key AS source, h, row_number() OVER (ORDER BY key NULLS FIRST) - 1 AS rank,
            count(*) OVER () AS n FROM a{leaf_levels}),
        {_levels("b", "b", group_levels)}
        u0 AS (SELECT doc_id, key, rank, leaf, claimed AS cur, '' AS proof FROM a0),
        {_folds("a", "u0", leaf_levels)}
        v0 AS (SELECT f.doc_id, f.leaf, b.h AS subroot, b.key AS key, b.rank AS rank, f.cur, f.proof
          FROM af{leaf_levels - 1} f JOIN b0 b ON f.key IS NOT DISTINCT FROM b.source),
        {_folds("b", "v0", group_levels)}
        top AS (SELECT h AS root FROM b{group_levels})
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
        FROM bf{group_levels - 1}, top"""
