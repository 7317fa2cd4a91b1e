"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from priceloom.session import settle


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is the smallest node reachable.

    Alternates two steps until nothing changes: every node hands its larger neighbours, then its smaller
    ones, to the smallest node it knows. Each step is one minimum per node (combined before the shuffle)
    and one join with a row per node, so a hub's neighbours never meet in memory. Every pair of steps is
    written to the shared folder. The number of steps grows with the logarithm of the longest path. Null or
    equal ends link nothing; repeated and reversed edges count once.
    """
    now = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    state = None
    for _ in range(rounds):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("u", "v", "m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v")))
        now = settle(small.where("u <> v").distinct(), "links")
        after = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"no stable components after {rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )
