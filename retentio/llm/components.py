"""Connected components of a graph of long ids, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut


def _to_least(edges: DataFrame, u: str, v: str) -> DataFrame:
    """Every neighbour of ``u`` with the least of u and its neighbours.

    The least is summed map-side, and the join lets a hub's rows be split.
    """
    least = edges.groupBy(F.col(u).alias("_u")).agg(F.min(v).alias("_m")).select("_u", F.least("_u", "_m").alias("_m"))
    return edges.join(least, edges[u] == F.col("_u")).select(u, v, "_m")


def settled(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(a, b) links to links (a, b), a > b, that connect the same nodes: of each node with the least of its component.

    Large-star and small-star steps alternate until nothing changes, or ``rounds`` times; every
    round is written to the shared checkpoint folder.  Loops and repeated links are allowed.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while rounds is None or rounds > 0:
        if rounds is None:
            state = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
            if state == seen or not state[0]:
                break
            seen = state
        else:
            rounds -= 1
        # Both ends of a link come from one scan; repeats are dropped once, at the end of the round.
        both = e.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        large = (_to_least(both, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
                 .where("a <> b"))
        small = _to_least(large, "a", "b").select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("_m").alias("b")), F.struct("a", F.col("_m").alias("b")))))
        e = cut(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    return e


def least_of(e: DataFrame) -> DataFrame:
    """(node, root) of the nodes of settled links: nodes of one root are of one component, and, where the
    links were settled to the end, those of one component have one root, its least node."""
    return (e.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("root")), F.struct(F.col("b").alias("node"), F.col("b").alias("root")))))
            .groupBy("node").agg(F.min("root").alias("root")))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links to (node, root): the least node of each node's component; nodes without links do not appear."""
    return least_of(settled(edges))
