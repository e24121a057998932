"""Connected components of a graph that no single task can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import staged


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; ``edges`` (big, small) with big > small."""
    both = edges.select(F.col("big").alias("u"), F.col("small").alias("v")).union(edges.select("small", "big"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("big"), F.col("m").alias("small")).distinct()
    least = large.groupBy("big").agg(F.min("small").alias("m"))
    moved = large.join(least, "big").where("small > m").select(F.col("small").alias("big"), F.col("m").alias("small"))
    return moved.union(least).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node.

    ``edges`` has two columns of node ids; loops and null ends are left out. Alternating star steps need a
    number of rounds logarithmic in the size of the components; each round is a table in the shared folder.
    """
    a, b = (F.col(name) for name in edges.columns[:2])
    edges = edges.where(a != b).select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small")).distinct()
    edges, before = staged(edges, "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("big", "small")), F.min("big"), F.max("small")).first()
        if now[0] == 0 or now == before:
            break
        edges, before = staged(_stars(edges), "edges"), now
    nodes = edges.select(F.col("big").alias("node"), F.col("small").alias("component"))
    return nodes.union(edges.select("small", "small")).distinct()
