"""Connected components of a large edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from adloom.session import materialize


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges(x, y)``; ``root`` is the component's smallest node.

    Each round hangs the larger neighbours of a node, then the node and its smaller
    neighbours, below the smallest of them, until the edges form stars. Rounds grow
    with the logarithm of the component's size, a node's neighbours are only
    aggregated by minimum, and each round is a written table, so neither a hub nor
    a long chain meets in one task and a lost executor costs a re-read. Repeated
    edges, loops and edges with a null end change nothing; no edges give no rows.
    """
    now = edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).filter("u > v").distinct()
    now, last = _stored(now, name)
    while last[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        now, found = _stored(small, name)
        if found == last:
            break
        last = found
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _stored(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The edges as a written table, and their number with a checksum."""
    seen = Observation()
    marked = edges.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(0)).alias("c"),
    )
    kept = materialize(marked, name)
    size = seen.get
    return kept, (size["n"], size["c"])
