"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import freeze


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Each round maps every node to the first of its neighbourhood, itself
    included, and contracts the edges by that map. Every other round orders
    the nodes by themselves, which folds stars around a small node at once;
    the next uses a fresh pseudo-random order (a hash of node and round),
    which shrinks any component by a constant factor on average, long chains
    as well, so the number of rounds stays logarithmic. The first neighbour is
    a partial aggregate and the relabelling a shuffle join, so a hub needs no
    task of its own. The driver sees one yes or no per round.
    """
    undirected = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
    cur = freeze(undirected.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    moves: list[DataFrame] = []
    while not cur.isEmpty():
        turn = len(moves)

        def rank(c: str, turn: int = turn):
            order = F.xxhash64(F.lit(turn), F.col(c)) if turn % 2 else F.col(c).cast("long")
            return F.struct(order.alias("h"), F.col(c).alias("n"))

        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = both.groupBy("u").agg(F.min(rank("v")).alias("m"))
        move = freeze(first.select("u", F.least(rank("u"), F.col("m"))["n"].alias("to")), "move")
        moves.append(move)
        half = cur.join(move, "u").select(F.col("to").alias("a"), "v")
        full = half.join(move.withColumnRenamed("u", "v"), "v").select("a", F.col("to").alias("b"))
        cur = freeze(
            full.where(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
            .distinct(),
            "edges",
        )
    if not moves:
        return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    # every node is in the first map; its label then moves on through the later ones
    labels = moves[0].select(F.col("u").alias("node"), F.col("to").alias("label"))
    for move in moves[1:]:
        later = move.select(F.col("u").alias("label"), "to")
        labels = labels.join(later, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    labels = freeze(labels, "labels")
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(smallest, "label").select("node", "component")
