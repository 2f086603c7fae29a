"""Connected components as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for each node with an edge to another; the component is its least node.

    Alternates large-star and small-star rounds: each node hands its larger, then its
    smaller neighbours to the least one it knows, until nothing moves. Rounds grow with
    the logarithm of the longest path, edges never outnumber the input's twofold. The least
    neighbour is pre-aggregated before its shuffle, joins of a hub can be split by AQE,
    and each round is written to the shared folder. NULL ends and loops are left out.
    """
    e = stored(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
               .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.select("hi", "lo").union(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("n")).agg(F.min("lo").alias("m")).withColumn("m", F.least("n", "m"))
        large = (both.join(least, both["hi"] == least["n"]).where(F.col("lo") > F.col("hi"))
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct())
        least = large.groupBy(F.col("hi").alias("n")).agg(F.min("lo").alias("m"))
        small = large.join(least, large["hi"] == least["n"])
        e = stored(small.select("hi", F.col("m").alias("lo"))
                   .union(small.where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
                   .distinct(), "edges")
        before, mark = mark, _mark(e)
        if mark == before:
            break
    return (e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .union(e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()))


def _mark(e: DataFrame) -> tuple:
    """Number of edges and a checksum of them."""
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
