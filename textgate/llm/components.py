"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgate.session import materialise


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, component)`` for every node that has an edge; component = its smallest node.

    ``edges`` holds two bigint columns; direction, repeats, self-loops and null ends do not matter
    (a self-loop gives its node its own component, a null end drops the edge). An empty table
    gives an empty table. Each round links a node's larger neighbours, then its smaller ones, to
    the smallest of them, so every component turns into a star in O(log² n) rounds. A round is
    two aggregations and two joins (skewed hubs are left to AQE's skew join) and ends in a written
    table; only its row count and hash reach the driver.
    """
    a, b = F.col(u).cast("long"), F.col(v).cast("long")
    pairs = edges.filter(a.isNotNull() & b.isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = materialise(pairs.distinct(), "edges")
    loops = pairs.filter("u = v")
    now = pairs.filter("u > v")
    seen = _signature(now)
    while seen[0]:
        both = now.select(F.col("u").alias("node"), F.col("v").alias("nbr")) \
            .unionByName(now.select(F.col("v").alias("node"), F.col("u").alias("nbr")))
        least = both.groupBy("node").agg(F.least(F.min("nbr"), F.first("node")).alias("m"))
        large = both.join(least, "node").filter("nbr > node").select(F.col("nbr").alias("u"), F.col("m").alias("v")) \
            .filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        now = materialise(small, "edges")
        before, seen = seen, _signature(now)
        if seen == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))) \
        .unionByName(loops.select(F.col("u").alias("node"), F.col("u").alias("component"))) \
        .groupBy("node").agg(F.min("component").alias("component"))
