"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.session import materialize


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node in ``links`` (a, b).

    Alternating star contraction: each node's larger neighbours, then its smaller ones, are tied to
    the smallest node around it, until nothing changes. Neighbours are only ever aggregated to
    their minimum, so a node with very many links is no group that a task must hold; tables between
    rounds are written to the shared folder. Self-links and nulls are passed over.
    """
    def bigger_first(df: DataFrame) -> DataFrame:
        return df.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    edges = materialize(bigger_first(links), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(bigger_first(large), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
        edges = materialize(bigger_first(small), "links")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    # now every node but the roots has one link, to its root
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
