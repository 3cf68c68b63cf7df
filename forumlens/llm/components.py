"""Connected components by alternating large-star and small-star rounds.

Every round is a minimum per node and a join.  A hub may have most of the links:
its minimum is combined before the shuffle, and the minima are dealt anew before
the join so that both of its sides are plain exchanges, whose large partitions
Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm import common as C


def _least(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return links.join(least.repartition(C.shuffle_width(links.sparkSession)), "u")


def _round(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u <> v").distinct()
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    small = _least(down)
    out = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        small.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _mark(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node that each linked node reaches.

    ``links`` has columns u and v of one orderable type; loops and repeats are
    allowed.  Nodes without a link to another are left out.
    """
    links = C.stored(links.select("u", "v").where("u <> v").distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        links = C.stored(_round(links), "links")
        new = _mark(links)
        if new == mark:
            break
        mark = new
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
