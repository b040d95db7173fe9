"""Helpers shared by the operators: table access, distributed connected components, local union of pairs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.plans.workspace import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_aside(docs: DataFrame) -> Column:
    """All columns but ``text`` as one struct, so that none can clash with a column that an operator makes."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])


def put_back(columns: list[str], row: str, text: str | Column = "text") -> list[Column]:
    """The ``columns`` that were set aside in ``row``, with ``text`` in its place."""
    text = F.col(text) if isinstance(text, str) else text
    return [(text if c == "text" else F.col(row).getField(c)).alias(c) for c in columns]


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` positions the smallest position reachable over the pairs (a[i], b[i])."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if (low == high).all():
            return root
        np.minimum.at(root, high, low)
        while not np.array_equal(root, up := root[root]):
            root = up


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of ``edges``; ``component`` is the smallest node reachable.

    Alternates two steps until nothing changes: link every neighbour above a node to the smallest of the
    neighbourhood, then link every neighbour below a node to the smallest of those. Each step is one
    aggregation with map-side minima and one join of written tables, whose frequent keys Spark can split; the
    rounds grow with the logarithm of the longest path. No node's neighbours are gathered in one place.
    Pairs with a null end are ignored. No edges give no rows.
    """
    u, v = F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    pairs = edges.where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
    current = written(pairs.select(u, v).distinct(), "edges")
    before = _signature(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        lowest = written(lowest, "lowest")
        above = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        above = written(above.distinct(), "above")
        least_below = written(above.groupBy("u").agg(F.min("v").alias("low")), "below")
        joined = above.join(least_below, "u")
        moved = joined.where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        current = written(
            least_below.select("u", F.col("low").alias("v")).unionByName(moved).distinct(), "edges"
        )
        after = _signature(current)
        if after == before:
            break
        before = after
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
