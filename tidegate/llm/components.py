"""Connected components of a distributed link table: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import written


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Each node ``u`` with its neighbours ``v`` joined to the smallest of them.

    large star: all neighbours take part, those above ``u`` move; small star: those below move.
    The smallest neighbour is an aggregate, so no neighbour list is ever gathered, and the join
    back has one row a node on one side: a hub's rows can be split.
    """
    sides = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        sides = sides.union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        sides = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = sides.join(least, "u")
    if both:
        moved = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def _settled(current: DataFrame) -> bool:
    """Whether the links, each from a larger to a smaller node, are stars: no end of one is a start, and none starts twice."""
    ends = current.select(F.col("a").alias("node"), F.lit(1).alias("starts"), F.lit(0).alias("ends")).union(
        current.select(F.col("b"), F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    return nodes.where("starts > 1 or (starts > 0 and ends > 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of the links ``a, b``.

    Rounds go on until every node of a component points at one, which then is the smallest; each round is written to the
    shared folder. Links in any direction, repeated links and links of a node with itself are
    allowed; null ends are left out. No links: no rows.
    """
    current = written(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    while not _settled(current):
        current = written(_star(_star(current, True), False), "stars")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)
