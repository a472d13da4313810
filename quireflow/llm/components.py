"""Connected components over a table of links, by alternating large-star and small-star rounds.

Every round is two aggregations over the links; the links stay distributed.  Each round is
checkpointed to the shared folder, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")


def _star(pairs: DataFrame, small: bool) -> DataFrame:
    """One star step over pairs (u, v). A node's least neighbour is found by a map-side combined
    aggregate; AQE may split the join that sends it back, so a hub isn't one task's work."""
    if small:
        pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = pairs.join(least, "u")
    if small:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the least node reachable.

    Self-links, repeated links and null ends are ignored; no links give no rows.
    """
    now = written(links.where("a <> b").select("a", "b").distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        large = _star(_both(now), small=False)
        new = written(_star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), small=True), "links")
        drop_written(now)
        # links as a set: count and an order-free checksum of both ends
        row = new.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        now = new
        if (row.n, row.h) == mark:
            break
        mark = (row.n, row.h)
    else:
        raise RuntimeError(f"components: no fixed point after {most_rounds} rounds")
    roots = now.groupBy("b").agg(F.lit(1).alias("_")).select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
