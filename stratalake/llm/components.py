"""Connected components of a graph given by its links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import saved


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return row.n, row.x


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (two columns of one type); root is its smallest node.

    Each round hooks nodes to the smallest neighbour they know and is written to the shared
    folder; the driver sees one count and one checksum a round. A node with many links is a
    group of a join, which adaptive execution splits; no list of neighbours is ever collected.
    Roots have no row with themselves; links of a node to itself are ignored.
    """
    a, b = links.columns
    links = saved(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    seen = _fingerprint(links)
    while seen[0]:
        # Large star: every larger neighbour of a node gets the smallest of its neighbourhood.
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: the smaller neighbours of a node and the node itself get the smallest of them.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        links = saved(small)
        now = _fingerprint(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
