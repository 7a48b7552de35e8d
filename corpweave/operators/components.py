"""Connected components of an undirected graph by alternating stars.

Each round replaces edges by edges to the least neighbour, first for larger and
then for smaller end points (the two-phase star contraction of Kiveris et al.,
SoCC 2014).  Only minima are aggregated and joined back, so no neighbourhood is
ever collected; a hub costs a partial aggregate and a join that adaptive
execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.storage import written


def _larger(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _smaller(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge to another one; component is
    the least node reachable.  Nulls and self-edges are ignored; parallel edges
    and direction do not matter.  An edgeless graph gives no rows."""
    now = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u is not null and v is not null and u <> v")
    now = written(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(max_rounds):
        if not state[0]:
            break
        now = written(_smaller(_larger(now)), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(members.select("component", "component").distinct().toDF("node", "component"))
