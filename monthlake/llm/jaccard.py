"""N-gram Jaccard join by vertical partitioning (operator 5).

The global order of all shingles is cut into fragments (ranges of their 64-bit hashes).
A document's set is cut the same way; each fragment counts by itself which shingles
several sets share and how often, and hands on only those. Overlaps of a pair are
counted fragment by fragment and summed per pair.

Steps, all in Spark:

1. Sets: one row per document with its set's size, a signature and a few minima of
   hashes. Equal sets are one class; only classes take part from here on.
2. Fragments: numpy packs the shingles of many documents by fragment; a fragment's task
   sorts about ``SHINGLES_PER_FRAGMENT`` and keeps those of at least two classes. Shingles
   that a hundredth of all documents share are known from step 1 and are dealt by
   document instead, and copies of frequent texts are left out before the shuffle.
3. What a class shares is put together again; a class can only link if that is four fifths
   of its set, and the others are done.
4. Leaders: classes with an equal minimum are paired with the one of them whose shingles
   are shared most (in a group of edited copies, the least edited), the overlaps are
   summed, and the links give first components. A group of any size costs a few pairs
   per class.
5. Prefixes in the order (how many share it, hash): classes of different components
   that share a shingle of their prefixes are paired, if length and position allow.
   Overlaps are summed again, and all links give the components.

No links are lost: two linked classes share a prefix shingle, so they are either in one
component after step 4 or paired in step 5. Shingles are compared by 64-bit hashes; sets
by two 64-bit sums, where an agreement in one alone is an error that is raised.

Defined results: a null or empty text and a text without words have an empty set: size 0,
linked with nothing, its own component. Rows with a null id keep their size; they link
by their text, and their component is the smallest id it reaches, or null. Rows that
repeat an id are answered each by its own text. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.components import across, components
from monthlake.llm.flat import Words, byte_table, mix, seed, shingles, slices, texts
from monthlake.llm.scratch import Scratch

WORDS = 5
PERCENT = 80
SHINGLES_PER_FRAGMENT = 2_500_000
#: Words are runs of bytes other than blanks.
WORD_BYTES = ~byte_table((0x20, 0x20), (0x09, 0x0D))
#: Minima of hashes by which leaders are found.
MINIMA = 3
#: Fragments of the order in which overlaps are counted.
FRAGMENTS = 3
#: Of a slice's classes, those that share a shingle before it is told of; and of all rows.
_SLICE_SHARE, _TOTAL_SHARE, _LEAST_HEAVY = 64, 128, 1000

_MINIMA = [f"m{i}" for i in range(MINIMA)]
_SETS = (
    "doc_id long, body long, n_shingles long, key long, check long, "
    + ", ".join(f"{m} long" for m in _MINIMA)
    + ", heavy array<long>, heavy_n array<int>"
)
_BLOCKS = "fragment int, keys binary, totals binary, lengths binary, shingles binary"
_SHARED = "bucket int, keys binary, totals binary, lengths binary, shingles binary, shared_by binary"
_SEGMENTS = "key long, n long, shared long, weight long, fragment int, shingles array<long>, shared_by array<int>"


class _Sets:
    """The distinct shingles of each text, sorted, one set after the other."""

    def __init__(self, part: pa.RecordBatch, size: int):
        words = Words(*texts(part.column("text")), WORD_BYTES)
        hashes, places = shingles(words.hashes(), words.of_text, size)
        for start, end in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
            hashes[start:end].sort()
        kept = np.ones(len(hashes), bool)
        kept[1:] = hashes[1:] != hashes[:-1]
        firsts = places[:-1]
        kept[firsts[firsts < len(hashes)]] = True
        before = np.concatenate([[0], np.cumsum(kept)])
        self.shingles = hashes[kept]
        self.at = before[places]
        self.sizes = np.diff(self.at)
        self.keys = self._sums("key")
        self.checks = self._sums("check")

    def _sums(self, name: str) -> np.ndarray:
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.shingles ^ seed(name)))])
            return mix(sums[self.at[1:]] - sums[self.at[:-1]] + self.sizes.astype(np.uint64))

    def minima(self, number: int) -> np.ndarray:
        out = np.zeros(len(self.sizes), np.uint64)
        filled = self.sizes > 0
        if filled.any():
            hashes = mix(self.shingles ^ seed(f"minimum {number}"))
            out[filled] = np.minimum.reduceat(hashes, self.at[:-1][filled])
        return out

    def one_of_each(self) -> np.ndarray:
        """The first of the texts with the same set, without those whose set is empty."""
        filled = np.flatnonzero(self.sizes)
        return filled[np.unique(self.keys[filled], return_index=True)[1]]

    def flat(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingles of the chosen sets, and for each the number of its set."""
        sizes = self.sizes[chosen]
        owner = np.repeat(chosen, sizes)
        starts = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(starts, sizes) + self.at[owner]
        return self.shingles[place], owner


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _sets_task(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _describe(part, size)

    return task


def _describe(part: pa.RecordBatch, size: int) -> pa.RecordBatch:
    sets = _Sets(part, size)
    chosen = sets.one_of_each()
    values, counts = np.unique(sets.flat(chosen)[0], return_counts=True)
    heavy = counts >= max(8, len(chosen) / _SLICE_SHARE)
    # The slice's frequent shingles go with its first row.
    empty = [None] * (part.num_rows - 1)
    columns = {
        "doc_id": part.column("doc_id").cast(pa.int64()),
        "body": part.column("body"),
        "n_shingles": pa.array(sets.sizes, pa.int64()),
        "key": pa.array(sets.keys.view(np.int64), mask=sets.sizes == 0),
        "check": _signed(sets.checks),
        **{m: _signed(sets.minima(i)) for i, m in enumerate(_MINIMA)},
        "heavy": pa.array([values[heavy].view(np.int64), *empty], pa.list_(pa.int64())),
        "heavy_n": pa.array([counts[heavy], *empty], pa.list_(pa.int32())),
    }
    return pa.RecordBatch.from_pydict(columns)


def _blocks_task(shared, fragments: int, size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copied, firsts, heavy, _ = shared.value
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                yield _pack(part, fragments, size, copied, firsts, heavy)

    return task


def _pack(part: pa.RecordBatch, fragments: int, size: int, copied: np.ndarray, firsts: np.ndarray, heavy: np.ndarray) -> pa.RecordBatch:
    """Shingles by fragment; those in ``heavy`` by key, in fragments of their own."""
    sets = _Sets(part, size)
    chosen = sets.one_of_each()
    if len(copied) and len(chosen):
        ids = part.column("doc_id").cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
        place = np.minimum(np.searchsorted(copied, sets.keys), len(copied) - 1)
        other = (copied[place] == sets.keys) & (firsts[place] != ids)
        # One that is not the first is left out, unless the first is among its slice's copies.
        same = ~other & (copied[place] == sets.keys)
        first_here = dict(zip(sets.keys[same].tolist(), np.flatnonzero(same).tolist(), strict=True))
        chosen = np.array(
            sorted({first_here.get(k, i) for i, k in zip(chosen.tolist(), sets.keys[chosen].tolist(), strict=True) if not other[i] or k in first_here}),
            np.int64,
        )
    values, owner = sets.flat(chosen)
    fragment = ((values >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)
    if len(heavy) and len(values):
        place = np.minimum(np.searchsorted(heavy, values), len(heavy) - 1)
        by_key = fragments + (sets.keys[owner] % np.uint64(fragments)).astype(np.int64)
        fragment = np.where(heavy[place] == values, by_key, fragment)
    order = np.argsort(fragment, kind="stable")
    fragment, owner, values = fragment[order], owner[order], values[order]
    new_run = np.ones(len(values), bool)
    new_run[1:] = (fragment[1:] != fragment[:-1]) | (owner[1:] != owner[:-1])
    runs = np.flatnonzero(new_run)
    lengths = np.diff(np.append(runs, len(values))).astype(np.int32)
    keys = sets.keys[owner[runs]]
    block_runs = np.flatnonzero(np.diff(fragment[runs], prepend=-1))
    totals = sets.sizes[owner[runs]].astype(np.int32)
    out: dict[str, list] = {"fragment": [], "keys": [], "totals": [], "lengths": [], "shingles": []}
    for start, end in zip(block_runs, np.append(block_runs, len(runs))[1:], strict=True):
        out["fragment"].append(int(fragment[runs[start]]))
        out["keys"].append(keys[start:end].tobytes())
        out["totals"].append(totals[start:end].tobytes())
        out["lengths"].append(lengths[start:end].tobytes())
        last = runs[end] if end < len(runs) else len(values)
        out["shingles"].append(values[runs[start] : last].tobytes())
    schema = pa.schema([("fragment", pa.int32()), *((name, pa.binary()) for name in ("keys", "totals", "lengths", "shingles"))])
    return pa.RecordBatch.from_pydict(out, schema=schema)


_KINDS = {"keys": np.uint64, "totals": np.int32, "lengths": np.int32, "shingles": np.uint64, "shared_by": np.int32}


def _joined(batches: Iterator[pa.RecordBatch], *names: str) -> list[np.ndarray]:
    """The packed columns of a group, each as one array."""
    parts: dict[str, list] = {name: [] for name in names}
    for batch in batches:
        for name, into in parts.items():
            into.extend(np.frombuffer(x.as_buffer(), _KINDS[name]) for x in batch.column(name))
    return [np.concatenate(parts.pop(name)) for name in names]


def _fragment_task(shared, fragments: int):
    """Of a fragment, the shingles that several classes have, packed by bucket of class."""

    def task(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = key[0].as_py()
        _, _, heavy, heavy_n = shared.value
        owners, totals, sizes, flat = _joined(batches, "keys", "totals", "lengths", "shingles")
        classes, first = np.unique(owners, return_index=True)
        once = np.zeros(len(owners), bool)
        once[first] = True
        flat = flat[np.repeat(once, sizes)]
        owner = np.repeat(np.searchsorted(classes, owners[once]).astype(np.int32), sizes[once])
        totals = totals[first]
        if number >= fragments:
            counts = heavy_n[np.searchsorted(heavy, flat)]
        else:
            order = np.argsort(flat)
            ordered = flat[order]
            starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            lengths = np.diff(np.append(starts, len(flat)))
            counts = np.empty(len(flat), np.int32)
            counts[order] = np.repeat(lengths, lengths)
            del order, ordered
            several = counts >= 2
            flat, owner, counts = flat[several], owner[several], counts[several]
        bucket = (classes % np.uint64(fragments)).astype(np.int32)[owner]
        order = np.lexsort((owner, bucket))
        flat, owner, counts, bucket = flat[order], owner[order], counts[order], bucket[order]
        runs = np.flatnonzero(np.diff(owner, prepend=-1) != 0)
        lengths = np.diff(np.append(runs, len(flat))).astype(np.int32)
        blocks = np.flatnonzero(np.diff(bucket[runs], prepend=-1))
        out: dict[str, list] = {name: [] for name in ("bucket", *_KINDS)}
        for start, end in zip(blocks, np.append(blocks, len(runs))[1:], strict=True):
            low, high = runs[start], runs[end] if end < len(runs) else len(flat)
            own = owner[runs[start:end]]
            out["bucket"].append(int(bucket[low]))
            for name, values in (
                ("keys", classes[own]), ("totals", totals[own]), ("lengths", lengths[start:end]),
                ("shingles", flat[low:high]), ("shared_by", counts[low:high]),
            ):
                out[name].append(values.tobytes())
        schema = pa.schema([("bucket", pa.int32()), *((name, pa.binary()) for name in _KINDS)])
        yield pa.RecordBatch.from_pydict(out, schema=schema)

    return task


def _assemble_task(percent: int):
    """Of a bucket, the classes that share enough, with what they share by fragment."""

    def task(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, totals, sizes, flat, counts = _joined(batches, *_KINDS)
        classes, first, number = np.unique(owners, return_index=True, return_inverse=True)
        totals = totals[first].astype(np.int64)
        shared = np.bincount(number, sizes, minlength=len(classes)).astype(np.int64)
        alive = 100 * shared >= percent * totals
        owner = np.repeat(number, sizes)
        weight = np.bincount(owner, counts, minlength=len(classes)).astype(np.int64)
        kept = alive[owner]
        flat, counts, owner = flat[kept], counts[kept], owner[kept]
        fragment = ((flat >> np.uint64(32)) * np.uint64(FRAGMENTS) >> np.uint64(32)).astype(np.int32)
        order = np.lexsort((flat, owner))
        flat, counts, owner, fragment = flat[order], counts[order], owner[order], fragment[order]
        starts = np.flatnonzero(np.diff(owner.astype(np.int64) * FRAGMENTS + fragment, prepend=-1))
        for low in range(0, len(starts), 10_000):
            part = starts[low : low + 10_000]
            end = starts[low + 10_000] if low + 10_000 < len(starts) else len(flat)
            at = pa.array(np.append(part, end) - part[0], pa.int32())
            own = owner[part]
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(classes[own]),
                    pa.array(totals[own]),
                    pa.array(shared[own]),
                    pa.array(weight[own]),
                    pa.array(fragment[part]),
                    pa.ListArray.from_arrays(at, _signed(flat[part[0] : end])),
                    pa.ListArray.from_arrays(at, pa.array(counts[part[0] : end])),
                ],
                names=["key", "n", "shared", "weight", "fragment", "shingles", "shared_by"],
            )

    return task


def _need(percent: int, *sizes: str) -> str:
    """SQL: the smallest overlap of two sets of these sizes that makes a link."""
    return f"ceil({percent} * ({' + '.join(sizes)}) / {100 + percent}.0D)"


def _links(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose overlaps, summed over the fragments, suffice."""
    left = segments.select(F.col("key").alias("a"), "fragment", F.col("shingles").alias("s"))
    right = segments.select(F.col("key").alias("b"), "fragment", F.col("shingles").alias("t"))
    overlaps = (
        pairs.join(left, "a")
        .join(right, ["b", "fragment"])
        .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("s", "t")).cast("long").alias("overlap"))
    )
    return (
        overlaps.groupBy("a", "b", "n_a", "n_b")
        .agg(F.sum("overlap").alias("overlap"))
        .where(f"100 * overlap >= {percent} * (n_a + n_b - overlap)")
        .select("a", "b")
    )


def similar_documents(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    shingles_per_fragment: int = SHINGLES_PER_FRAGMENT,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_shingles, component_id and class_id.

    ``component_id`` is the smallest doc_id that links reach, ``class_id`` the smallest of
    those with the same set.
    """
    return _labelled(docs, words, percent, shingles_per_fragment).drop("body", "group")


def _labelled(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    shingles_per_fragment: int = SHINGLES_PER_FRAGMENT,
) -> DataFrame:
    """The rows of `similar_documents` with a hash of their text, and their group, which ids may not name."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bodies = source.withColumn("body", F.xxhash64("text"))
    sets = scratch.put(bodies.mapInArrow(_sets_task(words), _SETS), "sets")

    classes = (
        sets.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("class_id"),
            F.max("n_shingles").alias("n"),
            F.count("*").alias("copies"),
            F.min("check").alias("check"),
            F.max("check").alias("other_check"),
            *(F.min(m).alias(m) for m in _MINIMA),
        )
    )
    classes = scratch.put(classes, "classes")
    totals = classes.agg(
        F.sum("copies").alias("rows"), F.sum("n").alias("shingles"), F.max(F.col("check") != F.col("other_check")).alias("clash")
    ).first()
    if totals.clash:
        raise ValueError("two different sets have one signature")
    rows, fragments = totals.rows or 0, max(1, -(-(totals.shingles or 0) // shingles_per_fragment))

    # At most 100,000 texts that have many copies, and a bounded number of shingles per
    # document that a hundredth of all share.
    copied = sorted(
        (r.key % (1 << 64), r.class_id)
        for r in classes.where((F.col("copies") >= max(16, rows / 100_000)) & F.col("class_id").isNotNull()).select("key", "class_id").toLocalIterator()
    )
    told = sets.where("heavy IS NOT NULL").select(F.explode(F.arrays_zip("heavy", "heavy_n")).alias("h"))
    heavy = sorted(
        (r.s % (1 << 64), min(r.n, 2**31 - 1))
        for r in told.groupBy(F.col("h.heavy").alias("s"))
        .agg(F.sum("h.heavy_n").alias("n"))
        .where(F.col("n") >= max(_LEAST_HEAVY, rows / _TOTAL_SHARE))
        .toLocalIterator()
    )
    shared = spark.sparkContext.broadcast(
        (
            np.array([k for k, _ in copied], np.uint64),
            np.array([i for _, i in copied], np.int64),
            np.array([s for s, _ in heavy], np.uint64),
            np.array([n for _, n in heavy], np.int32),
        )
    )
    segments = scratch.put(
        source.mapInArrow(_blocks_task(shared, fragments, words), _BLOCKS)
        .groupBy("fragment")
        .applyInArrow(_fragment_task(shared, fragments), _SHARED)
        .groupBy("bucket")
        .applyInArrow(_assemble_task(percent), _SEGMENTS),
        "segments",
    )

    alive = segments.select("key", "n", "shared", "weight").distinct().join(classes.select("key", *_MINIMA), "key")
    alive = scratch.put(alive, "alive")

    minima = alive.select("key", "n", "weight", F.posexplode(F.array(*_MINIMA)).alias("number", "minimum"))
    leaders = (
        minima.groupBy("number", "minimum")
        .agg(F.max(F.struct("weight", "key", "n")).alias("leader"), F.count("*").alias("members"))
        .where("members > 1")
    )
    close = f"100 * n_a >= {percent} * n_b AND 100 * n_b >= {percent} * n_a"
    pairs = (
        minima.join(leaders, ["number", "minimum"])
        .select(F.col("leader.key").alias("a"), F.col("key").alias("b"), F.col("leader.n").alias("n_a"), F.col("n").alias("n_b"))
        .where(f"a <> b AND {close}")
        .distinct()
    )
    first_links = scratch.put(_links(pairs, segments, percent), "links")
    roots = scratch.put(components(first_links, scratch), "roots")

    # The prefix of a set in the order (shared by how many, hash): what none shares comes first.
    ordered = (
        segments.groupBy("key")
        .agg(F.flatten(F.collect_list(F.arrays_zip("shared_by", "shingles"))).alias("all"))
        .join(alive.select("key", "n", "shared"), "key")
    )
    prefixes = ordered.select(
        "key",
        "n",
        (F.col("n") - F.col("shared")).alias("alone"),
        F.posexplode(F.expr(f"slice(sort_array(all), 1, cast(shared - ceil({percent} * n / 100.0D) + 1 AS int))")).alias("place", "entry"),
    ).select("key", "n", (F.col("alone") + F.col("place")).alias("place"), F.col("entry.shingles").alias("shingle"))
    postings = (
        prefixes.join(roots.withColumnRenamed("node", "key"), "key", "left")
        .select("shingle", F.col("key").alias("node"), "n", "place", F.coalesce("root", "key").alias("root"))
    )
    postings = scratch.put(postings, "postings")
    met = across(postings, "shingle", scratch, ("n", "place")).where(
        f"{close} AND 1 + least(n_a - place_a - 1, n_b - place_b - 1) >= {_need(percent, 'n_a', 'n_b')}"
    )
    pairs = met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "n_a", "n_b").distinct()
    second_links = scratch.put(_links(pairs, segments, percent), "links")
    roots_of_all = components(first_links.unionByName(second_links), scratch)

    members = roots_of_all.withColumnRenamed("node", "key").join(classes.select("key", "class_id"), "key")
    least = members.groupBy("root").agg(F.min("class_id").alias("component_id"))
    labels = scratch.put(
        classes.select("key", "class_id")
        .join(members.join(least, "root").select("key", "root", "component_id"), "key", "left")
        .select("key", "class_id", F.coalesce("component_id", "class_id").alias("component_id"), F.coalesce("root", "key").alias("group")),
        "labels",
    )
    scratch.drop(segments, postings, alive, classes, first_links, second_links, roots)
    return sets.join(labels, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        "body",
        "group",
    )


def keep_first_of_groups(docs: DataFrame) -> DataFrame:
    """One document of each group of similar ones; the same columns.

    The one with the smallest id stays, of one id the one with the smallest hash of its
    text; null ids come last. Documents are told apart by id and text, so a text that is no
    copy stays although its id has another one that goes. Rows that repeat both stay together.
    """
    scratch = Scratch(docs.sparkSession)
    found = _labelled(docs, WORDS, PERCENT, SHINGLES_PER_FRAGMENT).where("group IS NOT NULL").select("doc_id", "body", "group")
    found = scratch.put(found, "grouped")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "body")
    firsts = found.groupBy("group").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    others = found.join(firsts.select("group", "first"), "group").where(place != F.col("first"))
    others = scratch.put(others.select(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).distinct(), "others")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_body"))
    scratch.drop(found)
    return docs.join(others, same, "left_anti").select(*docs.columns)
