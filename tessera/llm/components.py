"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is two grouped minima and two joins. A hub with any number of neighbours is aggregated
before the shuffle; the minima are written before they are joined, so the join has a shuffle of its own
on either side, in which a hub's rows may be dealt to several tasks. Rounds are cut by a written table.
The tables of a graph of few edges are written by a task a core, whatever the number of shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.runtime import Scratch

#: Up to so many edges, a round's tables get as many files as the session has cores.
FEW_EDGES = 1 << 20


class _Few:
    """Scratch tables of a file a core at most."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.drop = scratch, scratch.drop

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return self.scratch.keep(df.coalesce(df.sparkSession.sparkContext.defaultParallelism), name)


def _stamp(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def _small_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges with u > v: hang u and all its smaller neighbours on the smallest of them."""
    low = scratch.keep(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    hung = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(low.select("u", F.col("m").alias("v"))).distinct()


def _large_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Hang every larger neighbour of u on the smallest node among u and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = scratch.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(u, v) links of comparable ids -> (node, root): each linked node and the smallest id it reaches.

    Nodes without links do not appear. Repeated, reversed and self links are harmless; links with
    a null end are ignored. An empty input gives an empty output.
    """
    e = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = scratch.keep(e, "edges")
    before = _stamp(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        own = _Few(scratch) if before[0] <= FEW_EDGES else scratch
        larger = own.keep(_large_star(e, own), "larger")
        nxt = own.keep(_small_star(larger, own), "edges")
        scratch.drop(larger)
        scratch.drop(e)
        e, now = nxt, _stamp(nxt)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    out = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return scratch.keep(out.union(roots), "components")
