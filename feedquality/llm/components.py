"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedquality.session import stage


def _stars(edges: DataFrame) -> bool:
    """Whether no vertex hangs on another one and has others hung on it, or hangs on two."""
    ends = edges.selectExpr("a as v", "1 as hangs", "0 as holds").union(edges.selectExpr("b", "0", "1"))
    return (ends.groupBy("v").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
            .filter("hangs > 1 or hangs > 0 and holds > 0").isEmpty())


def components(edges: DataFrame) -> DataFrame:
    """``v`` and ``root``, the smallest vertex reachable from it, for each vertex of ``edges(a, b)``.

    Large-star and small-star steps in turn: every vertex's larger neighbours, then its
    smaller ones, are hung on the smallest it knows, until the edges form stars. Each step
    is a minimum per vertex, combined before the shuffle, and a join that adaptive
    execution can split at a vertex with many neighbours. The edges are written to the
    shared folder after each round.
    """
    pairs = edges.filter("a <> b")
    current = stage(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(current):
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a")
        small = (hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        current = stage(small, "edges")
    roots = current.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("v"), "root").distinct())


def merged(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """``roots`` after further ``edges``: only the components that they touch are looked at again."""
    def root_of(df: DataFrame, column: str) -> DataFrame:
        named = roots.select(F.col("v").alias(column), F.col("root").alias("r"))
        return df.join(named, column, "left").withColumn(column, F.coalesce("r", column)).drop("r")

    between = root_of(root_of(edges.select("a", "b"), "a"), "b")
    again = stage(components(between).select(F.col("v").alias("old"), F.col("root").alias("new")), "again")
    moved = roots.join(again, roots["root"] == again["old"], "left").select("v", F.coalesce("new", "root").alias("root"))
    single = again.join(roots, again["old"] == roots["v"], "left_anti").select(F.col("old").alias("v"), F.col("new").alias("root"))
    return moved.union(single)
