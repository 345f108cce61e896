"""Near duplicates of embeddings by lattice hashing (operator 13).

Vectors of one label whose cosine is at least ``least_cosine`` are linked. Steps:

1. Classes: equal vectors of a label are one node with a weight. Nothing is paired with
   its own copies.
2. Cells: in each of ``TABLES`` tables, ``BLOCKS`` random projections to eight dimensions
   are decoded to the nearest point of the E8 lattice. The points and the label are a
   node's home cell; the ``PROBES`` cells next nearest to the projected vector are probed
   too. Tasks give hashes of cells only, no vectors.
3. Cores: every node is compared with the nodes of least rank (a hash) in the cells that
   it is in. If one lies within half of the greatest angle, the node joins its core, and
   once more that node's own core if it is as near. Any two of a core are linked by the
   triangle inequality, so they are counted, never paired: a group of near copies costs
   a few rows per copy, whatever its size.
4. Pairs of cores that meet in a cell, one of them at home there. (Most cores are single
   vectors.) Crowded cells compare the vectors of their cores block by block in numpy.
   The angle of two cores and their radii say that all of their members are linked, or
   none; where neither holds, the smaller one's members are compared with the larger
   core in the same way, and what is still open is compared vector by vector.
5. Links per node are summed, and the links give the components.

All links reported have that cosine, in double precision. Pairs may be missed: at a cosine
of 0.93 about 4 of 100, at 0.95 less than 1, at 0.98 none of 1,000 (tests/llm/test_lattice.py
measures it). A pair that meets in any cell is not lost afterwards.

Vectors of other length, or with another label, are not compared. Scale: projections do not
depend on the number of rows, so cells fill as it grows; ``BLOCKS`` = 3 suits some 10^9
vectors of a label. The one case that grows with the square of a group are unlike members
of two cores whose distance is neither surely a link nor surely none.

Defined results: a null label, a null or empty vector, one that holds null or values that
are not finite, and one of zeros only link with nothing; they are their own component and
are kept. Rows that repeat an id are answered each by its own vector. A row with a null id
links by its vector; its component is the least id it reaches, or null, and it is kept in
the latter case only. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.llm.components import components
from monthlake.llm.flat import mix, seed
from monthlake.llm.scratch import Scratch

LEAST_COSINE = 0.93
TABLES, BLOCKS, PROBES = 6, 2, 5
#: Width of the lattice, for projections whose coordinates have the variance of the vectors' length.
WIDTH = 2.0
#: Cores in a cell that are paired as rows; cells with more are compared in blocks of vectors.
CROWDED = 128
_BLOCK_ROWS = 512
#: Passes in which a node may move on to the core of its core's node.
_MOVES = 2
#: Angles that are compared with sums of angles are wrong by less.
_SLACK = 1e-7


def _minimal_vectors() -> np.ndarray:
    """The 240 lattice points nearest to the origin."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for signs in itertools.product((1.0, -1.0), repeat=2):
            vector = np.zeros(8)
            vector[[i, j]] = signs
            found.append(vector)
    halves = np.array(list(itertools.product((0.5, -0.5), repeat=8)))
    return np.concatenate([np.array(found), halves[(halves < 0).sum(1) % 2 == 0]])


_NEIGHBOURS = _minimal_vectors()


def _even_sum(x: np.ndarray) -> np.ndarray:
    """The nearest points of integers whose sum is even."""
    near = np.rint(x)
    odd = np.flatnonzero(np.rint(near.sum(1)).astype(np.int64) & 1)
    miss = x[odd] - near[odd]
    worst = np.abs(miss).argmax(1)
    near[odd, worst] += np.where(miss[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice point of each row of eight: even sums of integers, or of halves."""
    whole, half = _even_sum(x), _even_sum(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(1) < ((x - whole) ** 2).sum(1)
    return np.where(closer[:, None], half, whole)


def _near_points(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest point of each row and the n next ones around it, with what each adds in squared distance."""
    home = nearest_point(x)
    further = 2 - 2 * ((x - home) @ _NEIGHBOURS.T)
    chosen = np.argsort(further, axis=1, kind="stable")[:, :n]
    points = np.concatenate([home[:, None], home[:, None] + _NEIGHBOURS[chosen]], axis=1)
    return points, np.concatenate([np.zeros((len(x), 1)), np.take_along_axis(further, chosen, 1)], axis=1)


def _point_hashes(points: np.ndarray, salt: np.uint64) -> np.ndarray:
    """64 bits for each lattice point; twice a point's coordinates are integers."""
    h = np.full(points.shape[:-1], salt, np.uint64)
    doubled = np.rint(2 * points).astype(np.int64).view(np.uint64)
    for k in range(8):
        h = mix(h ^ doubled[..., k])
    return h


def cells(vectors: np.ndarray, tables: int, blocks: int, probes: int, width: float) -> np.ndarray:
    """Hashes [row, table, 1 + probes] of the cells of unit vectors; each table's first is the home."""
    n, length = vectors.shape
    out = np.zeros((n, tables, probes + 1), np.uint64)
    for t in range(tables):
        parts = []
        for b in range(blocks):
            matrix = np.random.default_rng([20_240_229, length, t, b]).normal(size=(length, 8)) / width
            points, further = _near_points(vectors @ matrix, probes)
            parts.append((_point_hashes(points, seed(f"cell {length} {t} {b}")), further))
        keys, further = parts[0]
        for more, added in parts[1:]:
            both = (further[:, :, None] + added[:, None, :]).reshape(n, -1)
            chosen = np.argsort(both, axis=1, kind="stable")[:, : probes + 1]
            i, j = chosen // more.shape[1], chosen % more.shape[1]
            keys = mix(np.take_along_axis(keys, i, 1) ^ mix(np.take_along_axis(more, j, 1)))
            further = np.take_along_axis(both, chosen, 1)
        out[:, t] = keys
    return out


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the rows that have it, and their vectors as unit vectors in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(at)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        matrix = values[at[:-1][rows][:, None] + np.arange(length)]
        matrix = matrix / np.abs(matrix).max(1, keepdims=True)
        yield rows, matrix / np.sqrt((matrix * matrix).sum(1, keepdims=True))


def _cells_task(tables: int, blocks: int, probes: int, width: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = np.zeros((tables, probes + 1), bool)
        home[:, 0] = True
        for whole in batches:
            for start in range(0, whole.num_rows, _BLOCK_ROWS):
                batch = whole.slice(start, _BLOCK_ROWS)
                node = batch.column("node").to_numpy()
                salt = batch.column("salt").to_numpy().view(np.uint64)
                for rows, matrix in _matrices(batch.column("embedding")):
                    found = mix(cells(matrix, tables, blocks, probes, width) ^ salt[rows][:, None, None])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "cell": pa.array(found.reshape(-1).view(np.int64)),
                            "node": pa.array(np.repeat(node[rows], home.size)),
                            "home": pa.array(np.tile(home.reshape(-1), len(rows))),
                        }
                    )

    return task


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the two vectors x and y by their cosine; both of a row have one length."""
    for batch in batches:
        cosine = np.zeros(batch.num_rows)
        ys = {y.shape[1]: y for _, y in _matrices(batch.column("y"))}
        for rows, x in _matrices(batch.column("x")):
            cosine[rows] = (x * ys[x.shape[1]]).sum(1)
        rest = [name for name in batch.schema.names if name not in ("x", "y")]
        yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in rest), pa.array(cosine)], names=[*rest, "cosine"])


def _compared(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Pairs (a, b and others) with their cosine."""
    x = vectors.select(F.col("node").alias("a"), F.col("embedding").alias("x"))
    y = vectors.select(F.col("node").alias("b"), F.col("embedding").alias("y"))
    types = ", ".join(f"{name} {kind}" for name, kind in pairs.dtypes)
    return pairs.join(x, "a").join(y, "b").select(*pairs.columns, "x", "y").mapInArrow(_cosines, f"{types}, cosine double")


def _rank(node: str) -> Column:
    return F.xxhash64(node, F.lit("rank"))


def _cores(postings: DataFrame, vectors: DataFrame, half: float, scratch: Scratch) -> DataFrame:
    """(node, core, cosine) of the nodes that lie within half of the angle of another one."""
    leaders = postings.where("home").groupBy("cell").agg(F.min(F.struct(_rank("node"), "node")).alias("leader"))
    seen = (
        postings.select("cell", "node")
        .join(leaders, "cell")
        .select(F.col("node").alias("a"), F.col("leader.node").alias("b"))
        .where(_rank("b") < _rank("a"))
        .distinct()
    )
    near = _compared(seen, vectors).where(F.col("cosine") >= half)
    best = near.groupBy("a").agg(F.min(F.struct(_rank("b"), "b", "cosine")).alias("best"))
    cores = scratch.put(best.select(F.col("a").alias("node"), F.col("best.b").alias("core"), "best.cosine"), "cores")
    for _ in range(_MOVES):
        onward = cores.select(F.col("node").alias("core"), F.col("core").alias("b"))
        moved = _compared(cores.join(onward, "core").select(F.col("node").alias("a"), "b"), vectors)
        moved = moved.where(F.col("cosine") >= half).select(F.col("a").alias("node"), F.col("b").alias("to"), F.col("cosine").alias("by"))
        following = cores.join(moved, "node", "left").select(
            "node", F.coalesce("to", "core").alias("core"), F.coalesce("by", "cosine").alias("cosine")
        )
        following = scratch.put(following, "cores")
        scratch.drop(cores)
        cores = following
    return cores


def _crowded_task(widest: float):
    """Pairs of a block's cores that may hold a link: their angle is at most ``widest`` and both radii."""

    def task(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        core, side = table.column("core").to_numpy(), table.column("side").to_numpy()
        radius, home = table.column("radius").to_numpy(), table.column("home").to_numpy(zero_copy_only=False)
        found_g, found_h = [], []
        for rows, matrix in _matrices(table.column("embedding")):
            one, other = np.flatnonzero(side[rows] == 0), np.flatnonzero(side[rows] == 1)
            if len(other) == 0:
                other = one
            angle = np.arccos(np.clip(matrix[one] @ matrix[other].T, -1, 1))
            one, other = rows[one], rows[other]
            near = angle <= widest + radius[one][:, None] + radius[other][None, :] + _SLACK
            i, j = np.nonzero(near & (home[one][:, None] | home[other][None, :]))
            g, h = core[one[i]], core[other[j]]
            found_g.append(np.minimum(g, h)[g != h])
            found_h.append(np.maximum(g, h)[g != h])
        return pa.table({"a": np.concatenate([*found_g, np.zeros(0, np.int64)]), "b": np.concatenate([*found_h, np.zeros(0, np.int64)])})

    return task


def _meetings(postings: DataFrame, nodes: DataFrame, groups: DataFrame, vectors: DataFrame, widest: float, crowded: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of cores that meet in a cell, each once."""
    present = (
        postings.join(nodes.select("node", "core"), "node").groupBy("cell", "core").agg(F.bool_or("home").alias("home"))
    )
    present = scratch.put(present, "present")
    several = present.groupBy("cell").agg(F.count("*").alias("n"), F.bool_or("home").alias("any")).where("n > 1 AND any").select("cell", "n")
    met = scratch.put(present.join(several, "cell"), "met")
    entry = F.struct("core", "home")
    listed = met.where(F.col("n") <= crowded).groupBy("cell").agg(F.sort_array(F.collect_list(entry)).alias("all"))
    paired = listed.select(F.posexplode("all").alias("i", "x"), "all").select(
        "x", F.explode(F.expr("slice(all, i + 2, size(all))")).alias("y")
    )
    pairs = paired.where("x.home OR y.home").select(F.col("x.core").alias("a"), F.col("y.core").alias("b"))

    # A crowded cell's cores are dealt to parts by a hash, and each pair of parts is a group.
    parts = F.ceil(F.col("n") / _BLOCK_ROWS).cast("int")
    full = met.where(F.col("n") > crowded).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("core"), F.col("parts")).cast("int"))
    other = F.explode(F.expr("sequence(0, parts - 1)")).alias("other")
    placed = full.select("cell", "core", "home", "part", other).select(
        "cell",
        "core",
        "home",
        F.least("part", "other").alias("low"),
        F.greatest("part", "other").alias("high"),
        F.when(F.col("part") <= F.col("other"), 0).otherwise(1).alias("side"),
    )
    shapes = groups.select("core", "radius").join(vectors.select(F.col("node").alias("core"), "embedding"), "core")
    blocks = placed.join(shapes, "core").groupBy("cell", "low", "high").applyInArrow(_crowded_task(widest), "a long, b long")
    return scratch.put(pairs.unionByName(blocks).distinct(), "meetings")


def _angle(cosine: str = "cosine") -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col(cosine))))


def _linked(vectors: DataFrame, scratch: Scratch, least_cosine: float, tables: int, blocks: int, probes: int, width: float, crowded: int):
    """(node, n_links) of the nodes that have links to other nodes, and edges (u, v) that join all linked ones."""
    widest = math.acos(least_cosine)
    half = math.cos(widest / 2 - _SLACK)
    task = _cells_task(tables, blocks, probes, width)
    postings = scratch.put(vectors.select("node", "salt", "embedding").mapInArrow(task, "cell long, node long, home boolean"), "cells")
    cores = _cores(postings, vectors, half, scratch)
    nodes = vectors.select("node", "weight").join(cores, "node", "left")
    nodes = nodes.select("node", "weight", F.coalesce("core", "node").alias("core"), F.when(F.col("core").isNotNull(), _angle()).otherwise(0.0).alias("off"))
    nodes = scratch.put(nodes, "nodes")
    groups = nodes.groupBy("core").agg(F.sum("weight").alias("total"), F.max("off").alias("radius"), F.count("*").alias("members"))
    groups = scratch.put(groups, "groups")

    pairs = _meetings(postings, nodes, groups, vectors, widest, crowded, scratch)
    a = groups.select(F.col("core").alias("a"), F.col("total").alias("total_a"), F.col("radius").alias("radius_a"), F.col("members").alias("members_a"))
    b = groups.select(F.col("core").alias("b"), F.col("total").alias("total_b"), F.col("radius").alias("radius_b"), F.col("members").alias("members_b"))
    apart = F.col("radius_a") + F.col("radius_b")
    judged = scratch.put(_compared(pairs.join(a, "a").join(b, "b"), vectors).where(_angle() <= widest + apart + _SLACK), "judged")
    single = (F.col("members_a") == 1) & (F.col("members_b") == 1) & (apart == 0)
    sure = F.when(single, F.col("cosine") >= least_cosine).otherwise(_angle() + apart <= widest - _SLACK)
    whole = judged.where(sure)
    first = F.struct(F.col("members_a"), F.col("a")) <= F.struct(F.col("members_b"), F.col("b"))
    small, large = F.when(first, F.col("a")).otherwise(F.col("b")), F.when(first, F.col("b")).otherwise(F.col("a"))
    larger = [F.when(first, F.col(f"{c}_b")).otherwise(F.col(f"{c}_a")).alias(c) for c in ("total", "radius", "members")]
    open_pairs = judged.where(~sure & ~single).select(small.alias("core"), large.alias("b"), *larger)

    # Members of the smaller core against the larger one as a whole.
    member = nodes.select("core", F.col("node").alias("a"), "weight")
    against = _compared(open_pairs.join(member, "core").select("a", "b", "weight", "total", "radius", "members"), vectors)
    against = scratch.put(against.where(_angle() <= F.col("radius") + widest + _SLACK), "against")
    alone = (F.col("members") == 1) & (F.col("radius") == 0)
    surely = F.when(alone, F.col("cosine") >= least_cosine).otherwise(_angle() + F.col("radius") <= widest - _SLACK)
    reached = against.where(surely)
    still = against.where(~surely & ~alone).select("a", "weight", F.col("b").alias("core"))
    last = still.join(nodes.select("core", F.col("node").alias("b"), F.col("weight").alias("weight_b")), "core").drop("core").where("a <> b")
    links = scratch.put(_compared(last, vectors).where(F.col("cosine") >= least_cosine), "links")

    by_core = (
        whole.select(F.col("a").alias("core"), F.col("total_b").alias("n"))
        .unionByName(whole.select(F.col("b").alias("core"), F.col("total_a").alias("n")))
        .unionByName(reached.select(F.col("b").alias("core"), F.col("weight").alias("n")))
        .groupBy("core")
        .agg(F.sum("n").alias("core_n"))
    )
    by_node = (
        reached.select(F.col("a").alias("node"), F.col("total").alias("n"))
        .unionByName(links.select(F.col("a").alias("node"), F.col("weight_b").alias("n")))
        .unionByName(links.select(F.col("b").alias("node"), F.col("weight").alias("n")))
        .groupBy("node")
        .agg(F.sum("n").alias("node_n"))
    )
    counted = nodes.join(groups.select("core", "total"), "core").join(by_core, "core", "left").join(by_node, "node", "left")
    n_links = F.col("total") - 1 + F.coalesce("core_n", F.lit(0)) + F.coalesce("node_n", F.lit(0))
    counted = scratch.put(counted.select("node", n_links.alias("n_links")), "counted")
    edges = (
        nodes.select(F.col("node").alias("u"), F.col("core").alias("v"))
        .unionByName(whole.select(F.col("a").alias("u"), F.col("b").alias("v")))
        .unionByName(reached.select(F.col("a").alias("u"), F.col("b").alias("v")))
        .unionByName(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    )
    roots = scratch.put(components(edges, scratch), "roots")
    scratch.drop(postings, cores, nodes, groups, pairs, judged, against, links)
    return counted, roots


def near_duplicates(
    embeddings: DataFrame,
    least_cosine: float = LEAST_COSINE,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    probes: int = PROBES,
    width: float = WIDTH,
    crowded: int = CROWDED,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings`` (vec_id, embedding, label)."""
    scratch = Scratch(embeddings.sparkSession)
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists(values, lambda x: x != 0)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label").select(
        "*",
        F.when(usable, F.xxhash64("label", "embedding")).alias("h"),
        F.when(usable, F.xxhash64("embedding", "label", F.lit(1))).alias("g"),
    )
    classes = (
        rows.where("h IS NOT NULL")
        .groupBy("h", "g")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"), F.first("embedding").alias("embedding"), F.first(F.xxhash64("label", F.lit(2))).alias("salt"))
    )
    classes = scratch.put(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    counted, roots = _linked(classes.select("node", "weight", "salt", "embedding"), scratch, least_cosine, tables, blocks, probes, width, crowded)
    named = classes.select("node", "h", "g", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answers = named.join(least, "root").join(counted, "node").select("h", "g", "n_links", "component_id")
    answers = scratch.put(answers, "answers")
    scratch.drop(classes, counted, roots)
    return rows.select("vec_id", "h", "g").join(answers, ["h", "g"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
