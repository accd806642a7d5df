"""Connected components of an edge table, with DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.textops import settle


def _star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the smallest node around it (large-star)."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return both.filter(F.col("y") > F.col("x")).join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them (small-star)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter(F.col("u") != F.col("v")).unionAll(least.select("u", F.col("m").alias("v")))


def _stars(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has no other neighbour: then stars change nothing."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    around = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not around.agg(F.max((F.col("up") > 0) & (F.col("up") + F.col("down") > 1))).first()[0]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (the smallest node reachable) of every node with an edge to another.

    Alternating large and small stars end in one star a component, in a few
    rounds even for long paths.  Minima are aggregated before the shuffle and
    the joins have one row a node on one side, so a node with very many
    neighbours can be split among tasks.  Each round is checkpointed.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col("u") != F.col("v"))
    e = settle(e.distinct())
    while not _stars(e):
        e = settle(_small_star(_star(e)).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
