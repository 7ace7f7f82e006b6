"""Connected components by alternating stars, in shuffles that combine before they move rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadra.session import written_once


def _lowest(edges: DataFrame) -> DataFrame:
    """Each (u, v) with ``m``, the smallest neighbour of u. A hot u is split by adaptive execution."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.hint("merge").join(low, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of all nodes in ``edges`` (u, v): comp is the smallest node that u is connected with.

    Every round replaces each node's neighbourhood by a star around its smallest member, first for the
    larger neighbours, then for the smaller ones, until nothing changes; the number of rounds grows with
    the logarithm of the longest path. Loops and repeated edges do no harm; no edges give no rows.
    """
    now = written_once(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _lowest(both).filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        small = _lowest(large.distinct())
        linked = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = written_once(linked.filter("u != v").distinct())
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    )
