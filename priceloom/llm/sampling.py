"""Choosing a bounded sample of labelled rows by hash."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from priceloom.session import settle


def first_by_hash(ids: DataFrame, group: str, most: int | Mapping, id: str = "doc_id") -> DataFrame:
    """(id, group): of each group at most ``most`` ids, those with the smallest hashes; ``ids`` are distinct.

    The groups are counted first. The count tells below which hash the chosen ones lie, give or take six
    standard deviations, so no task ranks more than little above ``most`` ids of a group, however many there are.
    Null groups choose nothing; an empty table gives none.
    """
    ids = settle(ids.where(F.col(group).isNotNull()).select(id, group), "ids")
    counts = {r[group]: r["count"] for r in ids.groupBy(group).count().collect()}
    bound = {value: most if isinstance(most, int) else most.get(value, 0) for value in counts}
    plan = [(v, bound[v], min(1.0, (bound[v] + 6 * math.sqrt(bound[v]) + 10) / n)) for v, n in counts.items()]
    kind = ids.schema[group].dataType.simpleString()
    plans = ids.sparkSession.createDataFrame(plan, f"_group {kind}, _most long, _below double")
    # One row per group, all of them at hand already: without the hint a group's ids would meet in one task.
    hashed = ids.withColumn("_hash", F.xxhash64(id)).join(F.broadcast(plans), F.col(group) == F.col("_group"))
    low = hashed.where(F.col("_hash") / F.lit(2.0**64) + 0.5 <= F.col("_below"))
    ranked = low.withColumn("_nth", F.row_number().over(Window.partitionBy(group).orderBy("_hash", id)))
    return ranked.where(F.col("_nth") <= F.col("_most")).select(id, group)
