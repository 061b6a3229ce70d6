"""Connected components by contraction, on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

LEAST_FIRST = 2


def families(members: DataFrame) -> DataFrame:
    """(node, label) of every node of the memberships (key, node): nodes that keys tie together
    have one label, the least node. The memberships are joined by key once, to tie each node to
    the least one of its key; most keys of a group have the same least node, so few distinct links
    are left for the rounds of ``components``."""
    least = members.groupBy("key").agg(F.min("node").alias("least"))
    links = members.join(least, "key").filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    nodes = members.select("node").distinct().join(components(links), "node", "left")
    return nodes.select("node", F.coalesce("label", "node").alias("label"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the undirected links (a, b); label: the least node.

    Each round ties a node to the first of itself and its neighbours (aggregated before the
    shuffle, so a node with very many links is no single task's work) and puts that one in its
    place: links within a class go, and equal ones become one, so later rounds join ever fewer
    rows. First is the least node in the first ``LEAST_FIRST`` rounds, which end stars and dense
    classes, then the one of least hash, another in each round, which takes a share of the nodes
    away in whatever order a path names them. Only a count reaches the driver.
    """
    links = written(links.select("a", "b").distinct(), "links")
    rounds = []
    while True:
        rounds.append(written(_firsts(links, len(rounds)), "firsts"))
        ends = [rounds[-1].toDF(c, f"{c}_first") for c in ("a", "b")]
        left = links.join(ends[0], "a").join(ends[1], "b").filter("a_first <> b_first")
        links = written(left.select(F.least("a_first", "b_first").alias("a"), F.greatest("a_first", "b_first").alias("b")).distinct(), "links")
        if links.isEmpty():
            break
    labels = rounds.pop()
    least = len(rounds) < LEAST_FIRST
    for earlier in reversed(rounds):
        labels = (earlier.withColumnRenamed("label", "first").join(labels.toDF("first", "label"), "first", "left")
                  .select("node", F.coalesce("label", "first").alias("label")))
    labels = written(labels, "labels") if rounds else labels
    if least:
        return labels
    names = labels.groupBy("label").agg(F.min("node").alias("least"))
    return written(labels.join(names, "label").select("node", F.col("least").alias("label")), "labels")


def _firsts(links: DataFrame, turn: int) -> DataFrame:
    """(node, label) of every node of the links: the first of itself and its neighbours."""
    both = links.union(links.select("b", "a")).toDF("node", "other")
    if turn < LEAST_FIRST:
        return both.groupBy("node").agg(F.least("node", F.min("other")).alias("label"))
    rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("hash"), F.col(c).alias("label"))
    return both.groupBy("node").agg(F.least(rank("node"), F.min(rank("other")))["label"].alias("label"))
