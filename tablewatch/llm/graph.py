"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``u, v``: for every node but the smallest of each component, that smallest one.

    ``links`` has two long columns ``u, v``. Each round hangs the larger neighbours of every node on
    its smallest neighbour, then the smaller ones; what remains are stars. Rounds grow with the
    logarithm of the longest chain. Links never leave the cluster; a node's links need not meet in
    one task, since the smallest neighbour is aggregated and joined back.
    """
    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .filter("u <> v").distinct(), "links")
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).alias("mark")
    before = edges.agg(mark).first()["mark"]
    while before[0]:
        both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
            edges.select(F.col("v").alias("a"), F.col("u").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m")), "least")
        large = stored(both.filter("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
                       .filter("u <> v").distinct(), "links")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = edges.agg(mark).first()["mark"]
        if after == before:
            break
        before = after
    return edges
