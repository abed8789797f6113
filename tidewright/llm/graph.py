"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root"))
    return (both.filter("b > a").join(lowest, F.col("a") == F.col("node"))
            .select(F.col("root").alias("a"), "b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    lowest = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    moved = edges.join(lowest, F.col("b") == F.col("node")).select(F.col("root"), F.col("a").alias("other"))
    return (lowest.select(F.col("root").alias("a"), F.col("node").alias("b"))
            .union(moved.filter("other <> root").select(F.col("root").alias("a"), F.col("other").alias("b"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b with a < b): the smallest node that
    can be reached. Loops until a round changes nothing; a round's table is written to
    the shared folder. Groups of any size are minima and joins by node, which combine
    before the shuffle or can be split; no group is collected. No links: no rows.
    """
    edges, before = links.select("a", "b").distinct(), None
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    star = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return star.union(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
