"""Connected components of links that lie in a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import discard, staged

#: Rounds that rank nodes by their id: stars around a smallest id, the usual shape, need no more.
PLAIN_ROUNDS = 2


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component_id): smallest id that the links (a, b) reach.

    Rounds of contraction: every node joins its neighbour of the smallest
    rank, and links between joined nodes fall away. After the plain rounds,
    ranks are drawn anew each round by a hash, so that about half of the nodes
    leave in a round whatever the shape, and long chains need few rounds. Hot
    nodes only take part in partial minima. Ids that no link names do not
    appear.
    """
    ends = links.where("a <> b").select("a", "b")
    ends = staged(ends.union(ends.select("b", "a")).distinct(), "cc-links")
    steps, first = [], ends
    while not ends.isEmpty():
        seed = F.lit(len(steps))
        a, b = ((F.col(c) if len(steps) < PLAIN_ROUNDS else F.xxhash64(c, seed)) for c in "ab")
        rank, own = F.struct(b.alias("h"), F.col("b").alias("id")), F.struct(a.alias("h"), F.col("a").alias("id"))
        step = staged(ends.groupBy("a").agg(F.min(rank).alias("other"))
                      .select("a", F.least("other", own).getField("id").alias("to")), "cc-step")
        onward = step.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        rest = staged(ends.join(step, "a").join(onward, "b").select(F.col("to").alias("a"), F.col("to_b").alias("b"))
                      .where("a <> b").distinct(), "cc-links")
        if ends is not first:
            discard(ends)
        steps.append(step)
        ends = rest

    def follow(parents: DataFrame, step: DataFrame) -> DataFrame:
        return (parents.join(step.withColumnRenamed("a", "root"), "root", "left")
                .select("id", F.coalesce("to", "root").alias("root")))

    nodes = first.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct()
    parents = reduce(follow, steps, nodes)
    if len(steps) > PLAIN_ROUNDS:
        smallest = parents.groupBy("root").agg(F.min("id").alias("component_id"))
        named = parents.join(smallest, "root")
    else:  # by id, every root is its component's smallest node
        named = parents.withColumnRenamed("root", "component_id")
    found = staged(named.select("id", "component_id"), "components")
    discard(first, *steps)
    return found
