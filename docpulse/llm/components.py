"""Connected components by alternating large and small stars (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpulse.llm.common import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for undirected edges ``a``, ``b``.

    Every round joins edges with the least neighbour of each node, a map-side minimum, and writes its edges to the shared
    folder, where they take the place of the last round's. Joins are merges, which adaptive execution splits at nodes with very many edges.
    """
    edge = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(edge)
    while True:
        both = edge.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edge.select("v", "u"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = (both.filter("y > x").join(least.hint("merge"), "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        to = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(to.hint("merge"), "u")
        small = joined.select("u", F.col("m").alias("v")).union(joined.select(F.col("v").alias("u"), F.col("m").alias("v")))
        made = stored(small.filter("u <> v").distinct(), "edges")
        before, state = state, _state(made)
        dropped(edge)
        edge = made
        if state == before:
            break
    stars = edge.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.union(edge.select("v", "v").distinct())


def _state(edge: DataFrame) -> tuple:
    low = F.lit(0xFFFFFFFF)
    return tuple(edge.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(low)), F.sum(F.xxhash64("v", "u").bitwiseAND(low))).first())
