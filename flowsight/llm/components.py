"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.session import written


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    near = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def signature(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("u") % 1_000_003)).first()
    return tuple(row)


def component_roots(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``u, v`` as longs) that is not the least of its component.

    Two stars per round, written to the shared folder, until a round changes nothing; a path of n
    nodes takes about log n rounds. Only the number of links and a checksum come to the driver.
    Links of a node to itself are ignored; an empty table gives an empty result.
    """
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = written(links, "links")
    before = signature(links)
    while before[0]:
        links = written(small_star(large_star(links)), "stars")
        after = signature(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
