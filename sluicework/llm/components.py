"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.llm.common import stored


def _lowest(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each ``u``; combined before the shuffle, then stored.

    Both sides of the join that follows are then plain exchanges, so that adaptive execution can split a hot ``u``.
    """
    return stored(edges.groupBy("u").agg(F.min("v").alias("low")), "lowest")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex hands its larger neighbours on to the smallest vertex it knows, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).withColumn("low", F.least("u", "low"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex hands its smaller neighbours, and itself, on to the smallest of them."""
    low = _lowest(edges)
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.filter("u > v").unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows ``(member, root)`` for every vertex that is not the smallest of its component.

    ``edges`` has two columns of longs; loops, repeated and reversed edges, and nulls are ignored. The steps move
    edges only to smaller vertices, so they end; their number grows with the logarithm of the longest chain. No
    component is gathered anywhere: every step is a minimum by vertex and a join.
    """
    now = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("member"), F.col("v").alias("root"))
        before = mark
        now = stored(_small_star(stored(_large_star(now).distinct(), "edges")), "edges")
