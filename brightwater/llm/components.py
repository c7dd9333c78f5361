"""Connected components of a graph of edges, by repeated local contraction in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.llm import common

#: The rounds from this one on go by turns by a fresh random order and by the nodes' own.
MIXED_FROM = 2


def components(edges: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """(node, component) of every node of edges (a, b): the smallest node that it is connected with.

    Each round every node goes over to the first of its neighbours and itself in some order, and the graph is contracted.
    By the nodes' own order a star is gone in two rounds, but a chain loses one node in each; by a random order drawn
    anew each time a part of the nodes goes whatever the graph, so rounds are logarithmic in the nodes. The moves are
    followed at the end. Nothing but counts comes to the driver; ``rounds`` gets those of the edges left.

    Defined cases: null ends are no edges, nor are ends that are equal; repeated edges count once; an edge may be given in
    either direction; without edges there are no rows; other columns are left out.
    """
    left = common.cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    moves = []
    while n := left.count():
        if rounds is not None:
            rounds.append(n)
        own = len(moves) < MIXED_FROM or len(moves) % 2 == 0
        place = lambda c, k=len(moves): F.struct(F.col(c).alias("x"), F.col(c).alias("id")) if own else F.struct(F.xxhash64(c, F.lit(k)).alias("x"), F.col(c).alias("id"))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy(F.col("a").alias("node")).agg(F.min(place("b")).alias("first"), F.count("*").alias("degree"))
        to = common.cut(to.select("node", F.least("first", place("node"))["id"].alias("to"), "degree"), "moves")
        moves.append(to.select("node", "to"))
        ends = left
        for end in ("a", "b"):
            named = to.select(F.col("node").alias(end), F.col("to").alias(f"{end}_to"), "degree")
            ends = common.cut(common.join_keyed(ends, named, [end], "degree").select(*(c for c in ("a", "b", "a_to", "b_to") if c != end and c in ends.columns), f"{end}_to"), "ends")
        left = common.cut(ends.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).where("a <> b").distinct(), "edges")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    out = moves[0].select("node", F.col("to").alias("component"))
    for to in moves[1:]:
        # Every node of a later round is the goal of earlier ones; goals of many nodes are few, so they are split off.
        out = _renamed(out, to.select(F.col("node").alias("component"), "to"))
    if len(moves) <= MIXED_FROM:
        return out  # by the nodes' own order alone each went to smaller ones
    return _renamed(out, out.groupBy("component").agg(F.min("node").alias("to")))


def _renamed(out: DataFrame, to: DataFrame) -> DataFrame:
    """out with the components that ``to`` (component, to) names in its terms; written."""
    sizes = out.groupBy("component").agg(F.count("*").alias("n"))
    step = common.cut(to.join(sizes, "component"), "steps")
    return common.cut(common.join_keyed(out, step, ["component"], "n", "left").select("node", F.coalesce("to", "component").alias("component")), "moves")
