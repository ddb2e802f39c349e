"""Connected components of an edge table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.stages import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v long): the smallest node that links reach.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each node hands its
    neighbours to its smallest neighbour until every node points at the smallest one. The minimum per
    node is pre-aggregated and joined back, so a node with very many links is split like any hot
    join key; each round is a written stage, and the driver sees one checksum a round.
    """
    links = edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = stage(links, "links")
    mark = _checksum(links)
    while mark[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(smallest, "u").filter(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v")).distinct()
        large = stage(large, "large-star")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").filter(F.col("u") != F.col("v")).distinct()
        links = stage(small, "small-star")
        before, mark = mark, _checksum(links)
        if before == mark:
            break
    out = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return out.unionByName(out.select(F.col("component").alias("node"), "component").distinct())


def _checksum(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
