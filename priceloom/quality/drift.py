"""Does the source still write as it used to?"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Share of texts that may be written otherwise than before.
BOUND = 0.05


def format_drift(shapes: DataFrame, order: tuple[str, ...] = ("dt", "hh"), bound: float = BOUND) -> DataFrame:
    """[*order, distance, drifted] of each slot, from [*order, shape, row_count].

    ``distance`` is the share of a slot's texts that would have to be of another shape for its shapes to be spread
    as in all slots before it together (total variation); above ``bound`` the slot has drifted. The first slot
    has nothing to drift from. A text counts once whatever its slot's size, so old slots weigh as much as new ones.
    """
    slot = F.struct(*order)
    earlier = Window.partitionBy("shape").orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    counted = shapes.groupBy(*order, "shape").agg(F.sum("row_count").alias("n"))
    counted = counted.withColumn("seen", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    totals = counted.groupBy(*order).agg(F.sum("n").alias("all"))
    # One row per slot, a few bytes each.
    totals = totals.withColumn("all_seen", F.sum("all").over(Window.orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)))
    shared = F.least(F.col("n") / F.col("all"), F.col("seen") / F.col("all_seen"))
    found = counted.join(totals, list(order)).groupBy(*order).agg((1 - F.sum(shared)).alias("distance"))
    distance = F.round(F.coalesce("distance", F.lit(0.0)), 12)
    return found.select(*order, distance.alias("distance"), (distance > bound).alias("drifted"))
