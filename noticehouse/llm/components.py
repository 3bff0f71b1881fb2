"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticehouse.llm.common import stage


def _signature(links: DataFrame) -> tuple:
    """Row count and an order-free hash of all rows."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).head())


def _large_star(links: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node it knows."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    met = both.join(least, "u").where("v > u")
    return met.select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node's smaller neighbours, and itself, to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    met = links.join(least, "u")
    moved = met.where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.withColumnRenamed("least", "v")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for all linked nodes.

    Every round is a written table, so plans stay short and a lost executor
    costs one round. The number of rounds grows with the logarithm of a
    component's size. Links to oneself give nothing.
    """
    start = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    links = stage(start.distinct(), "links")
    before = None
    while (now := _signature(links)) != before and now[0]:
        before = now
        links = stage(_small_star(_large_star(links)), "links", 2 * now[0])
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
