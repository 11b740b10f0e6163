"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import join_salted
from stratamart.staging import materialize


def components(links: DataFrame) -> DataFrame:
    """`a`, `b` (long, not null; any order, repeats and loops allowed) -> `node`, `root`: every node of a link
    that is not the smallest of its component, with that smallest node.

    Rounds of large and small stars: first every node's larger neighbours, then its smaller ones, are
    linked to the smallest node it knows, until all links lead to roots. Each round is a written table, so
    lineage stays short; joins on a node with many links are salted.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
                        .where("node != root").distinct(), "links")
    before = None
    while True:
        known = edges.groupBy("node").agg(F.min("root").alias("low"))
        large = join_salted(edges, "root", "node", known.withColumnRenamed("node", "root")).select(
            "node", F.coalesce("low", "root").alias("root")).distinct()
        small = large.groupBy("node").agg(F.min("root").alias("low"))
        pairs = join_salted(large, "node", "root", small).where("root != low").select(
            F.col("root").alias("node"), F.col("low").alias("root"))
        edges = materialize(pairs.union(small.select("node", F.col("low").alias("root"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))).first()
        if now == before:
            return edges
        before = now


def labelled(classes: DataFrame, links: DataFrame) -> DataFrame:
    """`cls`, `first` and links `a`, `b` between classes -> `cls`, `component`: the smallest `first` reachable by links."""
    roots = components(links).withColumnRenamed("node", "cls")
    rooted = materialize(classes.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    return join_salted(rooted, "root", "cls", smallest).select("cls", "component")
