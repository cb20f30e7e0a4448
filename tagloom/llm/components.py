"""Connected components by alternating stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import settled


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of an edge; the root is the smallest node of the component.

    In turn every node links its larger neighbours, then all its neighbours, to its smallest neighbour, until
    nothing changes. Minima are aggregated before the shuffle and no node's neighbours are ever gathered. The
    edges of a round are written to the shared folder, so the lineage stays short.
    """
    links = settled(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
        least = least.select("c", F.least("c", "m").alias("m"))
        large = both.join(least, both["u"] == least["c"]).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # The larger neighbours' own link is made by them; a smallest node keeps its links.
        links = settled(large.where(F.col("u") != F.col("v")).distinct())
        least = links.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
        joined = links.join(least, links["u"] == least["c"])
        small = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        links = settled(small.select("x.u", "x.v").where(F.col("u") != F.col("v")).distinct())
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
