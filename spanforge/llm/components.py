"""Connected components by alternating large-star and small-star steps; each step is two grouped joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.shared import dropped, written


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of long ids, in any direction, repeats allowed -> node, root (the component's least node) of every
    node that has an edge. No driver state but a checksum a round, which ends when no edge moves."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        moved = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        following = written(moved, "small-star")
        dropped(now, large)
        now = following
