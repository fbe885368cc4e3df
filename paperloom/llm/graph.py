"""Connected components of an edge table, without ever holding a component in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import common

ROUNDS = 200


def components(spark: SparkSession, edges: DataFrame, work: str) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Each round gives every node the least of itself and its neighbours (an aggregate that is summed before it is
    shuffled, so hubs don't matter) and contracts edges to these labels; loops and repeats go. Odd rounds go by the nodes
    themselves, so stars around a smallest node take one round. Even rounds go by a hash that is new each round: of any
    graph at most three quarters of the nodes with links are expected to be left after one, and half of a chain's, whatever
    its order. Rounds are cut at written tables. Links that are left after ``ROUNDS`` raise an error.
    """
    links = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    links = common.cut(spark, links, f"{work}/links0")
    labels, step = None, 0
    while not links.isEmpty():
        step += 1
        if step > ROUNDS:
            raise RuntimeError(f"components: links are left after {ROUNDS} rounds")
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # The hash of one long under one seed is one to one, so there are no ties.
        rank = (lambda c: F.xxhash64(F.lit(step), c)) if step % 2 == 0 else F.col
        least = both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", rank("b")).alias("to") if step % 2 == 0 else F.min("b").alias("to"))
        least = common.cut(spark, least.select("node", F.when(rank("to") < rank("node"), F.col("to")).otherwise(F.col("node")).alias("to")), f"{work}/least{step}")
        if labels is None:
            labels = least.select("node", F.col("to").alias("component"))
        else:
            labels = labels.join(least.select(F.col("node").alias("component"), "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        labels = common.cut(spark, labels, f"{work}/labels{step}")
        moved = links.join(least.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(least.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        links = common.cut(spark, moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a < b").distinct(), f"{work}/links{step}")
    if labels is None:
        return spark.createDataFrame([], "node long, component long")
    if step == 1:
        return labels
    # After a round by hash a label is some node of its component.
    names = labels.groupBy("component").agg(F.min("node").alias("name"))
    return common.cut(spark, labels.join(names, "component").select("node", F.col("name").alias("component")), f"{work}/names")
