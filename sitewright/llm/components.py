"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.session import materialise


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); root is the smallest node it can reach.

    Each round links every larger neighbour to the smallest one (large star), then every
    node to its smallest neighbour (small star). The table never holds more rows than the
    links given, hot nodes are only summed or joined, and only two numbers a round reach the
    driver. Null ends and self-links are no links; without links the result is empty.
    """
    given = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    given = given.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    edges, mark = materialise(given.distinct()), None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if mark == tuple(seen) or not seen[0]:
            break
        mark = tuple(seen)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        star = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct("u", F.col("low").alias("v"))))
        small = large.join(_lowest(large), "u").select(star.alias("e")).where("e.u != e.v")
        edges = materialise(small.select("e.u", "e.v").distinct())
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node").union(edges.select("v", "v").distinct())
