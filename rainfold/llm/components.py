"""Connected components of a graph that is spread over the cluster.

Two steps alternate until the edges are stars: every node's larger neighbours are linked to its
smallest one, then its smaller neighbours and itself. The stars stand around the smallest node of each
component, after a number of rounds that grows with the logarithm of the node count.
Before that each task joins the edges it holds by union-find, which leaves one edge for each node at
most and shortens paths.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rainfold.llm.storage import discard, stored


def _locally_joined(edges: DataFrame) -> DataFrame:
    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for frame in frames:
            for x, y in zip(frame["u"].tolist(), frame["v"].tolist()):
                x, y = root(x), root(y)
                parent[max(x, y)] = min(x, y)
        rows = [(x, root(x)) for x in parent]
        yield pd.DataFrame([r for r in rows if r[0] != r[1]], columns=["u", "v"]).astype("int64")

    return edges.mapInPandas(join, "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node either has edges to it only or is the larger node of one edge."""
    ends = edges.selectExpr("u as node", "1 as larger", "0 as smaller").unionByName(
        edges.selectExpr("v as node", "0 as larger", "1 as smaller")
    )
    counted = ends.groupBy("node").agg(F.sum("larger").alias("x"), F.max("smaller").alias("y"))
    return counted.where("x + y > 1").isEmpty()


def connected(links: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """node and component (its smallest node) for each node of ``links`` (long a, long b).

    The result's table is added to ``paths``; those of the steps before are removed.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    steps: list[str] = []
    edges = stored(_locally_joined(edges.where("u <> v")).distinct(), "stars", steps)
    while not _are_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "stars", steps)
        discard(links.sparkSession, *steps[:-1])
    if paths is not None:
        paths.append(steps[-1])
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def as_links(classes: DataFrame) -> DataFrame:
    """Links that give the classes again: each node with its component's smallest one."""
    return classes.select(F.col("node").alias("a"), F.col("component").alias("b"))
