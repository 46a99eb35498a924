"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum of an edge table."""

    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Every round is a few joins and aggregates on the edges, which partial
    aggregation and skew joins keep even for a hub with many neighbours; the
    rounds grow with the logarithm of the longest path. Each round is written
    to the shared folder. Self links, repeated links and links with a null end
    are dropped; an empty table gives no rows.
    """

    cur = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    cur = stage(cur, "edges")
    state = _state(cur)
    while state[0]:
        both = cur.union(cur.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("r"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("r").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("r"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", "r"), F.struct(F.col("v").alias("u"), "r"))).alias("e")
        )
        nxt = small.select(F.col("e.u").alias("u"), F.col("e.r").alias("v")).where("u != v").distinct()
        cur = stage(nxt, "edges")
        before, state = state, _state(cur)
        if state == before:
            break
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        cur.select("v", "v").distinct()
    )
