"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierflow.llm.common import stored
from tierflow.operators.joins import join_per_key


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); the root is the least node reachable.

    A large star hangs each larger neighbour of a node on the least neighbour, a small
    star each smaller one; both keep components whole.  When nothing changes, every node
    hangs on its root.  Each round is written to the shared folder.  Only the count and a
    checksum of the links go to the driver.
    """
    edges = stored(links.select("u", "v").filter("u <> v"))
    before = None
    for _ in range(max_rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _star(both, F.col("v") > F.col("u"))
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = stored(_star(down, F.lit(True), keep_node=True))
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            break
        before = state
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _star(edges: DataFrame, moved, keep_node: bool = False) -> DataFrame:
    """Hang the ``moved`` neighbours of each u on the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    hung = join_per_key(edges, least, ["u"]).filter(moved)
    out = hung.select(F.col("v").alias("u"), F.col("least").alias("v"))
    if keep_node:
        out = out.unionAll(least.select("u", F.col("least").alias("v")))
    return out.filter("u <> v").distinct()
