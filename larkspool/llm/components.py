"""Connected components by alternating large-star and small-star rounds (Kiveris et al., SoCC 2014), all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import forget, written

#: Far above what the rounds need (about the logarithm of the longest path); reaching it is an error, never a silent stop.
MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = written(least, "cc_least")  # both sides of the join are then plain exchanges, and hot nodes can be split
    out = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc_large")
    forget(least)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "cc_least")
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = written(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc_small")
    forget(least)
    return out


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges(u, v)``, longs, as a written table; the component is its smallest node.

    Each round is written to the shared folder, so lineage stays short and a lost executor costs one round; the rounds before
    are deleted.  No edges give no rows; loops and repeated edges change nothing.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        large = _large_star(now)
        forget(now)
        now = _small_star(large)
        forget(large)
        after = _state(now)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError("connected components did not converge")
    out = written(now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
    forget(now)
    return out
