"""Connected components of edges between integer ids, by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import written

#: Parts that the neighbours of one node are kept in.
SALTS = 64


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it.

    A node's neighbours are kept in ``SALTS`` parts, so a star's centre is no hot key: only the
    parts' smallest ones meet under the node itself.
    """
    both = _both(edges).withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    parts = both.groupBy("a", "salt").agg(F.min("b").alias("m"))
    least = parts.groupBy("a").agg(F.min("m").alias("m")).select("a", F.least("a", "m").alias("m"))
    told = parts.select("a", "salt").join(least, "a")
    return both.where("b > a").join(told, ["a", "salt"]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has an edge to another one.

    ``edges`` is (a, b) of longs without nulls. Each round is written to the shared folder; what
    comes to the driver is a sum over the edges. The number of rounds grows with the logarithm
    of a component's size. Loops and repeated edges do no harm; no edges give no rows.
    """
    stars, before = written(edges.select("a", "b").where("a <> b").distinct(), purpose), None
    while True:
        stars = written(_small_star(_large_star(stars)), purpose)
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
    tops = stars.select(F.col("b").alias("id")).distinct()
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(tops.select("id", F.col("id").alias("component")))
