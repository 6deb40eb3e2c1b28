"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempolith.llm.common import Scratch


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest of its neighbours and itself."""
    both = _neighbours(edges)
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").filter("v <> m").select(F.col("m").alias("u"), "v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours and itself to the smallest of them; edges go from small to large."""
    low = edges.groupBy("v").agg(F.min("u").alias("m"))
    linked = edges.join(low, "v").select(F.col("m").alias("u"), F.col("u").alias("v")).filter("u <> v")
    return linked.unionByName(low.select(F.col("m").alias("u"), "v")).distinct()


def components(edges: DataFrame, stage: Scratch, step: str = "cc") -> DataFrame:
    """(node, component): the smallest node that each node of an edge can reach. ``edges``: (u, v) with u < v.

    Rounds go on until a round changes nothing, which takes about the logarithm of the longest path.
    Every round is written to the shared folder, so a lost executor costs one round at most. The counts and
    hash sums that tell whether anything changed are all that reaches the driver.
    """
    now = stage.keep(edges.select("u", "v").distinct(), f"{step}0")
    seen, k = None, 0
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if mark == seen:
            break
        seen, k = mark, k + 1
        now = stage.keep(_small_star(_large_star(now)), f"{step}{k}")
        stage.drop(f"{step}{k - 1}")
    return now.select(F.col("v").alias("node"), F.col("u").alias("component"))
