"""Connected components of an edge table, by large-star and small-star rounds in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    larger = both.where("v > u")
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of an edge; ``edges`` has two columns of long.

    The root is the smallest node of the component. Each round is one job whose table
    replaces the last; the rounds end when a round changes nothing.
    """
    names = edges.columns
    current = edges.select(F.col(names[0]).alias("u"), F.col(names[1]).alias("v")).where("u <> v").distinct()
    current = scratch.put(current, "edges")
    mark = None
    while True:
        row = current.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (row.n, row.x) == mark or row.n == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = (row.n, row.x)
        following = scratch.put(_small_star(_large_star(current).distinct()).distinct(), "edges")
        scratch.drop(current)
        current = following


def across(members: DataFrame, group: str, scratch: Scratch, extra: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of a group's members that lie in different components, once or more each.

    ``members`` has the group, node, root and ``extra``; the pairs have node_a, node_b and
    so on. A group whose members are all of one component gives none, and a component
    that most of a group belongs to is not paired with itself: its rows only meet the
    group's others.
    """
    mixed = (
        members.groupBy(group, "root")
        .count()
        .groupBy(group)
        .agg(F.max_by("root", F.struct("count", "root")).alias("most"), F.count("*").alias("roots"))
        .where("roots > 1")
        .select(group, "most")
    )
    contested = scratch.put(members.join(mixed, group), "contested")
    columns = ("node", "root", *extra)
    x = contested.where("root <> most").select(group, *(F.col(c).alias(f"{c}_a") for c in columns))
    y = contested.select(group, "most", *(F.col(c).alias(f"{c}_b") for c in columns))
    return x.join(y, group).where("root_a <> root_b AND (root_b = most OR node_a < node_b)")
