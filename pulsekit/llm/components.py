"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _neighbour_min(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """-> (id, root): for every linked id, the smallest id of its component.

    Each round is two joins of the links with one minimum per node; links of a
    node with very many neighbours are pre-aggregated for the minimum, and the
    join back is an ordinary equi-join that adaptive execution may split.  The
    number of rounds grows with the logarithm of the longest chain.  Rounds are
    cut by ``checkpoint()``.  Self-links and repeated links change nothing; no
    links give no rows; links with a null end are dropped.
    """
    e = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"),
                      F.col(b).alias("_b"))
         .filter(F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("u") != F.col("v")))
         .select("u", "v").distinct().checkpoint())
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _neighbour_min(both).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = (large.join(_neighbour_min(large), "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter(F.col("u") != F.col("v")).distinct())
        e = small.checkpoint()
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("id"), F.col("v").alias("root"))
