"""Connected components by alternating star contractions."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, functions as F

from ordermetrics.llm.scratch import Scratch


def components(scratch: Scratch, links: DataFrame, label: str = "links") -> DataFrame:
    """(node, root) of every node of the links (a, b); root is the smallest node reachable.

    Each round links every neighbour of a node to the smallest node of its neighbourhood,
    first the larger neighbours and then the smaller ones, until the links are stars. Rounds
    grow with the logarithm of a component's size. Neighbourhoods are only ever reduced to
    their minimum, so a node with very many links is no larger task.
    """
    name = f"{label}-0"
    edges = scratch.keep(
        links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").filter("a > b").distinct(),
        name)
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    for turn in itertools.count(1):
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        low = both.groupBy("a").agg(F.min("b").alias("low")).select(
            "a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").filter("b > a").selectExpr("b AS a", "low AS b")
        large = scratch.keep(large.distinct(), f"{label}-{turn}-large")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").selectExpr("b AS a", "low AS b").filter("a > b")
        after = scratch.keep(small.union(low.select("a", "low")).distinct(), f"{label}-{turn}")
        same = edges.select(mark).first() == after.select(mark).first()
        scratch.drop(name, f"{label}-{turn}-large")
        edges, name = after, f"{label}-{turn}"
        if same:
            break
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return scratch.keep(edges.toDF("node", "root").union(roots), f"{label}-roots")
