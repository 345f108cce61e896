"""Exact top-k search by inner product with M-trees (operator 3).

Inner product is no metric; with one more component that gives every vector the length
of the longest, and 0 for a query, the nearest by Euclidean distance are those of the
largest inner product: d² = |q|² + R² - 2 q·x. Over that metric each task bulk-loads its
vectors into M-trees of at most ``TREE_SIZE``: pages of at most ``PAGE_SIZE`` entries, a
routing entry with its covering radius, every entry with its distance to the page's
parent. All vectors are indexed.

Queries go in blocks to every tree. A search takes pages best first, by the least
distance that their radius allows, and ends when none can hold a better one. In a page,
an entry is passed over without computing a distance if its stored parent distance and
the query's own already rule it out. Bounds leave room for rounding; what is kept is
compared by exact integers. A task keeps each query's best over its trees, and Spark
ranks the tasks' results.

Before, a bounded sample (``SEED_ROWS`` vectors) gives each query a score that its k-th
best reaches at least, so that pages are passed over from the start.

Defined results: vectors that are null, or hold null or non-finite components, and rows
with a null id take no part. Rows that repeat an id count once, with the smallest vector.
Vectors meet those of their own length. Ties go to the smaller id. A query with fewer
candidates gets all. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthlake.llm.scratch import Scratch

K = 10
SCALE = 1024
TREE_SIZE = 4096
PAGE_SIZE = 64
QUERIES_PER_BLOCK = 256
SEED_ROWS = 4096
#: Squared lengths up to which inner products, and sums on the way to them, are exact.
EXACT_IN_FLOATS, EXACT_IN_INTEGERS = 2.0**52, 2.0**62
_SLACK = 1e-7
_NONE = np.iinfo(np.int64).min


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """Components as floor(scale * x); null if the vector is null or not all finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(finite & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    """Lists of one length; float64 holds the integers of small vectors exactly."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def number_kind(squared_radius: float) -> type:
    """In what the greatest inner product of vectors of this squared length is exact."""
    return np.float64 if squared_radius < EXACT_IN_FLOATS else np.int64


def exact_dots(vectors: np.ndarray, query: np.ndarray, squared_radius: float) -> np.ndarray:
    """Inner products as int64: of floats that hold them, of int64, or of parts of 31 bits in Python's integers.

    The last gives what int64 holds of them, as scores are of that type.
    """
    if squared_radius < EXACT_IN_INTEGERS:
        return (vectors @ query).astype(np.int64)
    dots = vectors.astype(object) @ query.astype(object)
    return np.array([max(-(2**63), min(2**63 - 1, int(x))) for x in dots], np.int64)


class Tree:
    """Pages of one tree.

    A page is (children or None, rows, radii, parent distances): of a routing page, each
    entry has a page below it; of a leaf, none. ``rows`` number the tree's vectors.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, squared_radius: float):
        self.ids, self.vectors, self.squared_radius = ids, vectors, squared_radius
        self.floats = vectors.astype(np.float64, copy=False)
        self.lift = np.sqrt(np.maximum(squared_radius - (self.floats**2).sum(axis=1), 0))
        self.pages: list[tuple] = []
        self.root = self._load(np.arange(len(ids)), None)
        del self.lift

    def _distances(self, row: int, rows: np.ndarray) -> np.ndarray:
        dots = self.floats[rows] @ self.floats[row] + self.lift[rows] * self.lift[row]
        return np.sqrt(np.maximum(2 * (self.squared_radius - dots), 0))

    def _load(self, rows: np.ndarray, parent: int | None) -> int:
        """Makes the pages over these rows; the number of the uppermost."""
        to_parent = np.zeros(len(rows)) if parent is None else self._distances(parent, rows)
        if len(rows) <= PAGE_SIZE:
            self.pages.append((None, rows, np.zeros(len(rows)), to_parent))
            return len(self.pages) - 1
        groups = self._groups(rows)
        pivots = np.array([pivot for pivot, _ in groups])
        radii = np.array([self._distances(pivot, members).max() for pivot, members in groups])
        children = np.array([self._load(members, pivot) for pivot, members in groups])
        up = np.zeros(len(pivots)) if parent is None else self._distances(parent, pivots)
        self.pages.append((children, pivots, radii, up))
        return len(self.pages) - 1

    def _groups(self, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """At most a page's entries of groups: each row with its nearest of some far apart."""
        wanted = min(PAGE_SIZE, -(-len(rows) // (PAGE_SIZE // 2)))
        nearest = np.full(len(rows), np.inf)
        owner = np.zeros(len(rows), int)
        pivots: list[int] = []
        following = 0
        while len(pivots) < wanted:
            distances = self._distances(rows[following], rows)
            closer = distances < nearest
            owner[closer], nearest[closer] = len(pivots), distances[closer]
            pivots.append(int(rows[following]))
            following = int(nearest.argmax())
            if nearest[following] <= 0:
                break
        groups = [(pivot, rows[owner == i]) for i, pivot in enumerate(pivots)]
        groups = [(pivot, members) for pivot, members in groups if len(members)]
        if len(groups) < 2:  # all alike
            size = -(-len(rows) // wanted)
            return [(int(part[0]), part) for part in (rows[i : i + size] for i in range(0, len(rows), size))]
        return groups


class Best:
    """The best (score, id) of a query so far, and a score that the k-th reaches at least."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.heap: list[tuple[int, int]] = []  # (score, -id), the worst first

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for score, identity in zip(scores.tolist(), ids.tolist(), strict=True):
            entry = (score, -identity)
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)

    def floor(self) -> int:
        return max(self.least, self.heap[0][0]) if len(self.heap) == self.k else self.least


def search(tree: Tree, own: int, query: np.ndarray, best: Best) -> int:
    """Offers the tree's best to ``best``; the number of distances it computed."""
    whole, query = query, query.astype(np.float64, copy=False)
    length = float(query @ query) + tree.squared_radius
    room = _SLACK * np.sqrt(length) + 1e-6

    def reach() -> float:
        floor = best.floor()
        return np.inf if floor == _NONE else np.sqrt(max(length - 2.0 * floor, 0.0)) + room

    computed = 0
    queue: list[tuple[float, int, float]] = [(0.0, tree.root, np.nan)]  # bound, page, parent's distance
    while queue:
        bound, number, parent = heapq.heappop(queue)
        limit = reach()
        if bound > limit:
            break
        children, rows, radii, to_parent = tree.pages[number]
        if np.isnan(parent):
            near = np.arange(len(rows))
        else:
            near = np.flatnonzero(np.abs(parent - to_parent) - radii <= limit)
        if not len(near):
            continue
        computed += len(near)
        if children is None:
            ids, dots = tree.ids[rows[near]], exact_dots(tree.vectors[rows[near]], whole, tree.squared_radius)
            kept = (dots >= best.floor()) & (ids != own)
            best.offer(dots[kept], ids[kept])
        else:
            dots = tree.floats[rows[near]] @ query
            distances = np.sqrt(np.maximum(length - 2 * dots, 0))
            bounds = np.maximum(distances - radii[near], 0)
            for i in np.flatnonzero(bounds <= limit):
                heapq.heappush(queue, (float(bounds[i]), int(children[near[i]]), float(distances[i])))
    return computed


_PAGES = pa.schema([("tree", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("pages", pa.list_(pa.struct([("children", pa.binary()), ("rows", pa.binary()), ("radii", pa.binary()), ("to_parent", pa.binary())])))])
_TREES = "tree long, dim int, ids binary, vectors binary, pages array<struct<children: binary, rows: binary, radii: binary, to_parent: binary>>"


def _packed(number: int, tree: Tree) -> dict:
    return {
        "tree": number,
        "dim": tree.vectors.shape[1],
        "ids": tree.ids.astype(np.int64).tobytes(),
        "vectors": tree.vectors.tobytes(),
        "pages": [
            {
                "children": None if children is None else children.astype(np.int32).tobytes(),
                "rows": rows.astype(np.int32).tobytes(),
                "radii": radii.tobytes(),
                "to_parent": to_parent.tobytes(),
            }
            for children, rows, radii, to_parent in tree.pages
        ],
    }


def _unpacked(row: dict, squared_radius: float) -> Tree:
    tree = Tree.__new__(Tree)
    tree.squared_radius = squared_radius
    tree.ids = np.frombuffer(row["ids"], np.int64)
    tree.vectors = np.frombuffer(row["vectors"], number_kind(squared_radius)).reshape(-1, row["dim"])
    tree.floats = tree.vectors.astype(np.float64, copy=False)
    tree.pages = [
        (
            None if p["children"] is None else np.frombuffer(p["children"], np.int32),
            np.frombuffer(p["rows"], np.int32),
            np.frombuffer(p["radii"], np.float64),
            np.frombuffer(p["to_parent"], np.float64),
        )
        for p in row["pages"]
    ]
    tree.root = len(tree.pages) - 1
    return tree


def build_trees(vectors: DataFrame, squared_radius: float, tree_size: int = TREE_SIZE) -> DataFrame:
    """Trees over (vec_id, vector of long), one row each; the pages are an array in it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def built(dim: int) -> pa.RecordBatch:
            nonlocal number
            parts = waiting.pop(dim)
            tree = Tree(np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts]), squared_radius)
            number += 1
            return pa.RecordBatch.from_pylist([_packed(number, tree)], schema=_PAGES)

        for batch in batches:
            lengths = np.asarray(batch.column("vector").value_lengths())
            for dim in np.unique(lengths).tolist():
                rows = batch.filter(pa.array(lengths == dim))
                for start in range(0, rows.num_rows, tree_size):
                    part = rows.slice(start, tree_size)
                    have = sum(len(i) for i, _ in waiting.get(dim, []))
                    if have and have + part.num_rows > tree_size:
                        yield built(dim)
                    waiting.setdefault(dim, []).append((part.column("vec_id").to_numpy(), _matrix(part.column("vector"), number_kind(squared_radius))))
        for dim in list(waiting):
            yield built(dim)

    return vectors.mapInArrow(task, _TREES)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    tree_size: int = TREE_SIZE,
    queries_per_block: int = QUERIES_PER_BLOCK,
    seed_rows: int = SEED_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best of all others for each query.

    ``vectors`` has vec_id and embedding; ``is_query`` says of vec_id which are queries.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    usable = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding"), scale).alias("vector"))
        .where("vec_id IS NOT NULL AND vector IS NOT NULL")
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
    )
    usable = scratch.put(usable, "vectors")
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    squared_radius = float(usable.agg(F.max(squares)).first()[0] or 0.0)
    kind = number_kind(squared_radius)
    rounding = 0.0 if kind is np.float64 else squared_radius * 1e-12
    trees = scratch.put(build_trees(usable, squared_radius, tree_size), "trees")

    seeds = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(seed_rows).collect()
    by_length: dict[int, list] = {}
    for row in seeds:
        by_length.setdefault(len(row.vector), []).append(row)
    shared = spark.sparkContext.broadcast(
        {n: (np.array([r.vec_id for r in rows]), np.array([r.vector for r in rows], np.float64)) for n, rows in by_length.items()}
    )

    # Blocks of queries with the scores that the seeds promise.
    def block_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = np.asarray(batch.column("vector").value_lengths())
            for dim in np.unique(lengths).tolist():
                rows = batch.filter(pa.array(lengths == dim))
                for start in range(0, rows.num_rows, queries_per_block):
                    part = rows.slice(start, queries_per_block)
                    ids, queries = part.column("vec_id").to_numpy(), _matrix(part.column("vector"), kind)
                    least = np.full(len(ids), _NONE)
                    known, seed_vectors = shared.value.get(dim, (np.zeros(0, int), np.zeros((0, dim))))
                    if len(known) > k and squared_radius < EXACT_IN_INTEGERS:
                        dots = queries.astype(np.float64, copy=False) @ seed_vectors.T
                        dots[ids[:, None] == known[None]] = -np.inf
                        # Rounded sums promise a little less than they say.
                        least = np.partition(dots, -k, axis=1)[:, -k] - rounding
                        least = np.maximum(least, -(2.0**62)).astype(np.int64)
                    number += 1
                    yield pa.RecordBatch.from_pydict(
                        {"block": [number], "dim": pa.array([dim], pa.int32()), "query_ids": [ids.tobytes()], "queries": [queries.tobytes()], "least": [least.tobytes()]}
                    )

    schema = "block long, dim int, query_ids binary, queries binary, least binary"
    queries = usable.where(is_query).coalesce(max(1, spark.sparkContext.defaultParallelism))
    blocks = scratch.put(queries.mapInArrow(block_task, schema), "queries")

    def search_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, tuple[np.ndarray, np.ndarray, list[Best]]] = {}
        last: tuple[int, Tree] | None = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if last is None or last[0] != row["tree"]:
                    last = (row["tree"], _unpacked(row, squared_radius))
                if row["block"] not in states:
                    if len(states) >= 64:  # what was found so far goes on; the memory is free
                        yield _rows(states)
                        states = {}
                    ids = np.frombuffer(row["query_ids"], np.int64)
                    vectors = np.frombuffer(row["queries"], kind).reshape(len(ids), -1)
                    states[row["block"]] = (ids, vectors, [Best(k, int(x)) for x in np.frombuffer(row["least"], np.int64)])
                for own, query, best in zip(*states[row["block"]], strict=True):
                    search(last[1], int(own), query, best)
        yield _rows(states)

    def _rows(states: dict) -> pa.RecordBatch:
        found = [
            (own, -minus, score)
            for ids, _, bests in states.values()
            for own, best in zip(ids.tolist(), bests, strict=True)
            for score, minus in best.heap
        ]
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    # Every tree meets every block: trees are dealt to as many groups as tasks may run,
    # and each block goes to all groups.
    groups = max(1, min(trees.count(), 4 * spark.sparkContext.defaultParallelism))
    placed = trees.withColumn("group", F.pmod(F.xxhash64("tree"), F.lit(groups)))
    sent = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    met = placed.join(sent, ["group", "dim"]).select("tree", "dim", "ids", "vectors", "pages", "block", "query_ids", "queries", "least")
    found = met.mapInArrow(search_task, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
