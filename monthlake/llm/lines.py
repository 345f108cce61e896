"""Fuzzy deduplication of lines by MinHash (operator 1), in DataFrame functions only.

A line counts in lower case without blanks at its ends; equal lines are one node. Its set
are the runs of ``SHINGLE`` characters (UTF-16 units). Steps:

1. Signatures: ``BANDS`` x ``ROWS`` minima of hashes of all runs, per distinct line. The
   minimum of hash XOR mask over a set is a minimum hash for every mask. Runs are taken
   several to a row, so the aggregation sees a part of a line at once, and it combines
   inside the tasks before the shuffle.
2. Bands: lines that agree in a band's minima share a bucket. A sketch of two bits of each
   minimum goes with the line, and only pairs whose sketches disagree in at most ``MOST_APART``
   places are candidates, so no set is made for the others. Every line goes to its buckets once,
   by numbers alone; a bucket of at most ``AT_ONCE`` lines gives all its candidates there and is
   done, and of a larger one each line is first paired with the bucket's smallest and largest node.
   Only the lines of larger buckets are stored for the steps that follow.
3. Verification: the exact Jaccard coefficient of the pairs' sets must reach
   ``least_jaccard``. Runs are compared by 32-bit hashes: in a pair of lines of 350
   characters, one run counts as common by mistake three times in 100,000. The lines travel to
   their pairs, and the sets, four times as large, are made there. No pair is verified twice.
4. Components of the links. Larger buckets that still hold several components are paired within
   if they are small (``FEW``); others are first cut into smaller ones by some bits of the sketch,
   ``CUTS`` times by other bits, and one that stays large pairs its lines with its ends. These
   pairs are verified too, and the components are joined.
   Buckets of more than ``FEW`` lines that then still hold several components are compared pair by
   pair, every pair once, a pair of blocks of ``BLOCK`` lines to a task, and these pairs are
   verified and joined too.
5. Of each component the first line stays, by doc_id, a hash of the text and place; the others go.

Pairs of Jaccard 0.8 are found with a probability of about 0.9 for sets of 20 runs and 0.96
for larger ones, of 0.9 nearly always: masks are no independent hashes, so this is a little
less than the bands alone promise (tests/llm/test_lines.py measures it). One changed
character inside a line of n breaks ``SHINGLE`` runs, which leaves (n - 2 * SHINGLE + 1) /
(n + 1) in common: with runs of 4 such lines are linked from 39 characters on, with runs of
8 only from 79. A change at an end breaks fewer. Runs of 3 would link lines from 29 on, but
lines of one language share so many of them that most lines become candidates.

Defined results: empty and blank lines always stay. Null texts stay null; empty texts stay
empty. A null id comes after all others. Rows that repeat both id and text are one document
and are answered alike. A line shorter than a run is its own only run. A text all of whose
lines go becomes empty, and ``n_kept`` is 0. Other columns are passed through; columns named
like those that are added are replaced.
"""

from __future__ import annotations

import functools
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthlake.llm.components import components
from monthlake.llm.scratch import Scratch, one_map

#: Short, so that one edit in a short line leaves most runs; see above.
SHINGLE = 4
#: Short runs are common to unlike lines too, so a band takes five minima to agree.
BANDS, ROWS = 10, 5
LEAST_JACCARD = 0.8
#: Minima whose two bits may differ in a candidate: 0.15 of all are expected at a Jaccard of 0.8, 0.45 at 0.4.
MOST_APART = 0.36
#: Lines of a bucket that are all paired with each other, without a look at components and with one; times that a larger bucket is cut.
AT_ONCE, FEW, CUTS = 8, 24, 4
#: Lines of a block: what stays of a bucket of several components is compared pair by pair, a pair of blocks at a time.
BLOCK = 2048
#: Runs that one row holds while minima are taken.
_RUNS_PER_ROW = 16
_MINIMA_PER_WORD = 31
_LAST = 2**63 - 1
#: Columns that documents have while their lost lines are looked up.
_KEY = "_gone_key"
_KEY_COLUMNS = (_KEY, f"{_KEY}_word", f"{_KEY}_bits", f"{_KEY}_maybe")
#: Blanks that do not count at a line's ends; a line of nothing else is blank.
_BLANKS = " \t\r\x0b\x0c"


def _masks(n: int) -> list[int]:
    numbers = random.Random(20_240_229)
    return [numbers.getrandbits(32) - 2**31 for _ in range(n)]


def _occurrences(docs: DataFrame) -> DataFrame:
    """(id, body, at, line) of every line that is not blank, as it counts."""
    lines = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"),
        F.xxhash64("text").alias("body"),
        F.posexplode(F.split("text", "\n")).alias("at", "line"),
    )
    return lines.withColumn("line", F.lower(F.btrim("line", F.lit(_BLANKS)))).where("line <> ''")


def _named(lines: DataFrame) -> DataFrame:
    """Adds the two hashes that a line is known by."""
    return lines.withColumns({"h": F.xxhash64("line"), "g": F.xxhash64("line", F.lit(1))})


def signatures(occurrences: DataFrame, bands: int, rows: int, shingle: int) -> DataFrame:
    """(h, g, sketch: array of long, bands: array of long) per distinct line."""
    units = F.encode("line", "UTF-16BE")
    lines = _named(occurrences).select("h", "g", units.alias("units"))
    lines = lines.withColumn("last", F.greatest(F.lit(1), F.octet_length("units") - 2 * shingle + 1))
    step = 2 * _RUNS_PER_ROW
    parts = lines.select("h", "g", "units", "last", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(step))).alias("i"))
    hashes = [f"r{k}" for k in range(_RUNS_PER_ROW)]
    hashed = parts.select(
        "h", "g",
        *(F.hash(F.expr(f"substring(units, least(i + {2 * k}, last), {2 * shingle})")).alias(name) for k, name in enumerate(hashes)),
    )
    minima = [
        F.min(F.least(*(F.col(name).bitwiseXOR(F.lit(mask)) for name in hashes))).alias(f"m{j}")
        for j, mask in enumerate(_masks(bands * rows))
    ]
    grouped = hashed.groupBy("h", "g").agg(*minima)
    keys = [F.xxhash64(F.lit(b), *(f"m{b * rows + r}" for r in range(rows))) for b in range(bands)]
    # Two bits of each minimum, those of 31 minima in a number.
    words = []
    for start in range(0, bands * rows, _MINIMA_PER_WORD):
        own = range(start, min(start + _MINIMA_PER_WORD, bands * rows))
        bits = [F.shiftleft(F.col(f"m{j}").bitwiseAND(F.lit(3)).cast("long"), 2 * (j - start)) for j in own]
        words.append(functools.reduce(lambda x, y: x.bitwiseOR(y), bits))
    return grouped.select("h", "g", F.array(*words).alias("sketch"), F.array(*keys).alias("bands"))


def apart(x: Column, y: Column, words: int) -> Column:
    """Minima whose bits differ in two sketches."""
    total = F.lit(0)
    for i in range(words):
        both = x[i].bitwiseXOR(y[i])
        total = total + F.bit_count(both.bitwiseOR(F.shiftrightunsigned(both, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total


def _flagged(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Adds ``{key}_maybe``: whether the row's key, a hash, may be among the wanted.

    A filter of 2^24 bits in at most 2^18 rows, whatever the number of rows: few wanted
    keys let few others pass; with very many it passes all and costs nothing but itself.
    """
    word, bit = F.shiftrightunsigned(key, 46), F.col(key).bitwiseAND(F.lit(63)).cast("int")
    at, held = f"{key}_word", f"{key}_bits"
    bits = wanted.groupBy(word.alias(at)).agg(F.expr(f"bit_or(shiftleft(1L, cast({key} & 63L AS int)))").alias(held))
    met = rows.withColumn(at, word).join(F.broadcast(bits), at, "left")
    return met.withColumn(f"{key}_maybe", F.coalesce(F.getbit(held, bit) == 1, F.lit(False))).drop(at, held)


def _maybe(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose key may be among the wanted, so that few are shuffled.

    What follows should be an inner join: a semi join would be moved below the filter.
    """
    return _flagged(rows, wanted, key).where(f"{key}_maybe").drop(f"{key}_maybe")


def _met(members: DataFrame, few: int) -> DataFrame:
    """Members (bucket, node, ...) of buckets of several nodes, with the bucket's ``size`` and, as
    ``others``, the members that each is paired with: the ones before it in a bucket of at most
    ``few``, so that every pair is there once, and the bucket's ends in a larger one.

    One shuffle; a bucket passes through a buffer that goes to disk if it is large.
    """
    columns = [c for c in members.columns if c != "bucket"]
    in_order = Window.partitionBy("bucket").orderBy("node")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sized = members.withColumn("size", F.count("*").over(whole)).where("size > 1")
    own = F.struct(*columns)
    before = F.collect_list(F.when(F.col("size") <= few, own)).over(in_order.rowsBetween(1 - few, -1))
    ends = F.array(F.first(own).over(whole), F.last(own).over(whole))
    return sized.withColumns({"before": before, "ends": ends}).select(
        "bucket", *columns, "size", F.when(F.col("size") <= few, F.col("before")).otherwise(F.col("ends")).alias("others")
    )


def _shared(nodes: DataFrame, words: int, most_apart: int, scratch: Scratch, few: int = AT_ONCE) -> DataFrame:
    """(bucket, node, sketch, size, near): ``near`` are the nodes that a member is paired with and
    that may be like it. Members without any are there for buckets of more than ``few`` only."""
    entries = nodes.select(F.explode("bands").alias("bucket"), "node", *(F.col("sketch")[i].alias(f"s{i}") for i in range(words)))
    sketch = lambda row: F.array(*(row[f"s{i}"] for i in range(words)))
    met = _met(entries, few).withColumn("sketch", F.array(*(f"s{i}" for i in range(words))))
    alike = F.filter("others", lambda o: (o["node"] != F.col("node")) & (apart(F.col("sketch"), sketch(o), words) <= most_apart))
    met = met.withColumn("near", F.transform(alike, lambda o: o["node"]))
    large = F.col("size") > few
    found = met.where(large | (F.size("near") > 0)).select(
        F.when(large, F.col("bucket")).alias("bucket"), "node", F.when(large, F.col("sketch")).alias("sketch"), "size", "near"
    )
    return scratch.put(found, "shared")


def _runs(line: str, shingle: int) -> Column:
    """Distinct 32-bit hashes of the runs of a line, by its UTF-16 form.

    That form is an item of an array: as a column of a row it would be copied for every run.
    """

    def of_units(units: Column) -> Column:
        last = F.greatest(F.lit(1), F.octet_length(units) - 2 * shingle + 1)
        starts = F.sequence(F.lit(1), last, F.lit(2))
        return F.array_distinct(F.transform(starts, lambda i: F.hash(F.substring(units, i, F.lit(2 * shingle)))))

    return F.get(F.transform(F.array(F.encode(line, "UTF-16BE")), of_units), F.lit(0))


def _verified(pairs: DataFrame, lines: DataFrame, least_jaccard: float, shingle: int) -> DataFrame:
    """The pairs (a, b) the Jaccard coefficient of whose lines' sets suffices; ``lines`` are (node, n, line)."""
    # Sizes meet first: a line travels to pairs of sets of like sizes only.
    n_a, n_b = (lines.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}")) for k in "ab")
    line_a, line_b = (lines.select(F.col("node").alias(k), F.col("line").alias(f"line_{k}")) for k in "ab")
    small = F.least("n_a", "n_b") >= least_jaccard * F.greatest("n_a", "n_b")
    met = pairs.join(n_a, "a").join(n_b, "b").where(small).join(line_b, "b").join(line_a, "a")
    # Exploded from an array of one, so that the condition does not make the sets again.
    common = F.size(F.array_intersect(_runs("line_a", shingle), _runs("line_b", shingle)))
    met = met.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), F.explode(F.array(common)).alias("common"))
    return met.where(F.col("common") >= least_jaccard * (F.col("n") - F.col("common"))).select("a", "b")


def _sized(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with the bucket's size."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("root").alias("r"), F.max("root").alias("s"))
    return members.join(sizes.where("r < s").select("bucket", "size"), "bucket")


def across(members: DataFrame, near: Column, words: int, scratch: Scratch, few: int = FEW) -> DataFrame:
    """Pairs (a, b) of members (bucket, node, sketch, root) that may be alike and are not joined yet."""
    mixed = scratch.put(_sized(members), "mixed")
    large = mixed.where(F.col("size") > few)
    parts = [mixed.where(F.col("size") <= few)]
    for cut in range(CUTS):
        # Enough bits that a bucket of unlike lines leaves about half of ``few`` in each.
        bits = F.least(F.lit(40), F.ceil(F.log2(F.col("size") / (few / 2))) + 1).cast("int")
        word = F.col("sketch")[cut % words]
        part = F.shiftrightunsigned(word, 10 * (cut // words)).bitwiseAND(F.expr("shiftleft(1L, bits)") - 1)
        parts.append(large.withColumn("bits", bits).withColumn("bucket", F.xxhash64("bucket", F.lit(cut), part)))
    parts = [part.select("bucket", "node", "sketch", "root") for part in parts]
    met = _met(functools.reduce(DataFrame.unionByName, parts), few)
    met = met.select(F.col("node").alias("x"), F.col("sketch").alias("sketch_x"), F.col("root").alias("root_x"), F.explode("others").alias("other"))
    met = met.select("x", "sketch_x", "root_x", F.col("other.node").alias("y"), F.col("other.sketch").alias("sketch_y"), F.col("other.root").alias("root_y"))
    pairs = met.where((F.col("x") != F.col("y")) & (F.col("root_x") != F.col("root_y")) & near)
    found = scratch.put(_ordered(pairs.select("x", "y")), "pairs")
    scratch.drop(mixed)
    return found


def _blocked(members: DataFrame, block: int) -> DataFrame:
    """Members (bucket, node, sketch, root, size) under keys (bucket, lo, hi): a bucket's nodes are
    dealt to blocks of about ``block``, and each pair of blocks is one key that holds both, so that
    every pair of a bucket meets under exactly one key and no task holds a whole large bucket."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / block)).cast("long")
    dealt = members.withColumn("own", F.pmod(F.xxhash64("node"), blocks))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return dealt.select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node", "sketch", "root")


def rest(members: DataFrame, near: Column, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of all members (bucket, node, sketch, root) of a bucket that still holds several
    components, that may be alike: the exact way for what ``across`` leaves, however large the bucket."""
    # Only the members are stored; their copies, one for each block of the bucket, go straight to the join.
    sized = scratch.put(_sized(members), "mixed")
    mixed = _blocked(sized, block)
    x = mixed.select("bucket", "lo", "hi", F.col("node").alias("x"), F.col("sketch").alias("sketch_x"), F.col("root").alias("root_x"))
    y = mixed.select("bucket", "lo", "hi", F.col("node").alias("y"), F.col("sketch").alias("sketch_y"), F.col("root").alias("root_y"))
    pairs = x.join(y, ["bucket", "lo", "hi"]).where((F.col("x") < F.col("y")) & (F.col("root_x") != F.col("root_y")) & near)
    found = scratch.put(_ordered(pairs.select("x", "y")), "pairs")
    scratch.drop(sized)
    return found


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _lines_of(occurrences: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, scratch: Scratch) -> DataFrame:
    """(node, line, n) of the nodes of pairs (a, b); n is the size of the line's set."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    keyed = nodes.select("h", "g", "node", F.xxhash64("node").alias("key"))
    named = _maybe(keyed, wanted.select(F.xxhash64("node").alias("key")), "key").join(wanted, "node").select("h", "g", "node")
    named = scratch.put(named, "wanted")
    lines = _named(_maybe(occurrences.select("line", F.xxhash64("line").alias("h")), named, "h"))
    # Equal lines are combined inside the tasks; the two hashes stand for the line.
    lines = lines.groupBy("h", "g").agg(F.first("line").alias("line"))
    found = scratch.put(lines.join(named, ["h", "g"]).select("node", "line", F.size(_runs("line", shingle)).alias("n")), "lines")
    scratch.drop(named)
    return found


def line_components(
    docs: DataFrame,
    scratch: Scratch,
    least_jaccard: float = LEAST_JACCARD,
    bands: int = BANDS,
    rows: int = ROWS,
    shingle: int = SHINGLE,
) -> DataFrame:
    """(h, g, component) of the lines of ``docs`` (doc_id, text) that are linked with unlike ones."""
    occurrences = _occurrences(docs)
    signed = signatures(occurrences, bands, rows, shingle).withColumn("node", F.monotonically_increasing_id())
    with one_map(docs.sparkSession):
        nodes = scratch.put(signed, "signatures")
    words = -(-bands * rows // _MINIMA_PER_WORD)
    most_apart = int(MOST_APART * bands * rows)
    near = apart(F.col("sketch_x"), F.col("sketch_y"), words) <= most_apart
    shared = _shared(nodes, words, most_apart, scratch)
    members = shared.where("bucket IS NOT NULL").select("bucket", "node", "sketch", F.col("size").alias("all"))

    def verified(pairs: DataFrame) -> DataFrame:
        lines = _lines_of(occurrences, nodes, pairs, shingle, scratch)
        links = scratch.put(_verified(pairs, lines, least_jaccard, shingle), "links")
        scratch.drop(lines)
        return links

    def rooted(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        roots = scratch.put(components(links, scratch), "roots")
        return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), roots

    def unseen(pairs: DataFrame, *before: DataFrame) -> DataFrame:
        """The pairs that no step before has verified; takes the place of ``pairs``."""
        new = scratch.put(pairs.join(functools.reduce(DataFrame.unionByName, before), ["a", "b"], "left_anti"), "pairs")
        scratch.drop(pairs)
        return new

    first = scratch.put(_ordered(shared.select(F.col("node").alias("x"), F.explode("near").alias("y"))), "pairs")
    first_links = verified(first)
    of_roots, roots = rooted(first_links)
    second = unseen(across(of_roots, near, words, scratch), first)
    scratch.drop(roots)
    second_links = verified(second)
    links = first_links.unionByName(second_links)
    of_roots, roots = rooted(links)
    # Buckets that still hold several components: every pair of them, so that no candidate is left out.
    third = unseen(rest(of_roots.where(F.col("all") > FEW).drop("all"), near, scratch), first, second)
    scratch.drop(roots, shared)
    third_links = verified(third)
    scratch.drop(first, second, third)
    roots = components(links.unionByName(third_links), scratch)
    found = nodes.select("node", "h", "g").join(roots, "node").select("h", "g", F.col("root").alias("component"))
    found = scratch.put(found, "components")
    scratch.drop(nodes, first_links, second_links, third_links)
    return found


def dedup_lines(docs: DataFrame, least_jaccard: float = LEAST_JACCARD) -> DataFrame:
    """Documents whose ``text`` keeps one line of each component; n_lines and n_kept added.

    Both count lines that are not blank, before and after.
    """
    scratch = Scratch(docs.sparkSession)
    source = docs.select("doc_id", "text")
    labels = line_components(source, scratch, least_jaccard)
    # A line that is linked with no other is a component of its own: its two hashes.
    placed = _named(_occurrences(source)).select("id", "body", "at", "h", "g").join(labels, ["h", "g"], "left")
    linked = F.col("component").isNotNull()
    placed = placed.select(F.coalesce("component", "h").alias("c"), F.when(~linked, F.col("g")).alias("d"), "id", "body", "at")
    placed = scratch.put(placed, "places")
    place = F.struct("id", "body", "at")
    several = placed.groupBy("c", "d").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    theirs = several.select(F.col("c").alias("of_c"), F.col("d").alias("of_d"), "first", F.xxhash64("c", "d").alias("key"))
    theirs = scratch.put(theirs, "several")
    repeated = _maybe(placed.withColumn("key", F.xxhash64("c", "d")), theirs, "key").drop("key")
    gone = (
        repeated.join(theirs, (F.col("c") == F.col("of_c")) & F.col("d").eqNullSafe(F.col("of_d")))
        .where(place != F.col("first"))
        .groupBy("id", "body")
        .agg(F.collect_set("at").alias("_gone"))
    )
    gone = scratch.put(gone, "gone")
    scratch.drop(placed, theirs, labels)
    kept = docs.drop("n_lines", "n_kept", "_gone", "_id", "_body", "_lines", *_KEY_COLUMNS)
    keyed = kept.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "_body": F.xxhash64("text")})
    # Documents that surely lose no line are not shuffled.
    keyed = keyed.withColumn(_KEY, F.xxhash64("_id", "_body"))
    theirs = gone.select(F.col("id").alias("_id"), F.col("body").alias("_body"), "_gone")
    flagged = _flagged(keyed, theirs.select(F.xxhash64("_id", "_body").alias(_KEY)), _KEY)
    met = flagged.where(_KEY_COLUMNS[-1]).join(theirs, ["_id", "_body"], "left")
    joined = met.unionByName(flagged.where(~F.col(_KEY_COLUMNS[-1])), allowMissingColumns=True)
    # Exploded from an array of one, so that a text is split once and not for every line.
    joined = joined.withColumn("_lines", F.explode(F.array(F.split("text", "\n"))))
    lines = F.col("_lines")
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    text = F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")
    n_lines = F.size(F.filter(lines, lambda line: F.btrim(line, F.lit(_BLANKS)) != ""))
    n_lines = F.when(lines.isNull(), 0).otherwise(n_lines)
    return joined.select(
        *(F.when(F.col("_gone").isNull(), F.col("text")).otherwise(text).alias("text") if c == "text" else joined[c] for c in kept.columns),
        n_lines.alias("n_lines"),
        (n_lines - F.coalesce(F.size("_gone"), F.lit(0))).alias("n_kept"),
    )


def keep_new_lines(docs: DataFrame) -> DataFrame:
    """Documents without repeated lines; those of which nothing is left go. The same columns."""
    deduped = dedup_lines(docs)
    left = deduped.where((F.col("n_kept") > 0) | (F.col("n_lines") == 0))
    if "n_chars" in docs.columns:
        same = F.length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.when(F.col("n_kept") < F.col("n_lines"), same).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)
