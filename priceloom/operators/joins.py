"""Dimension look-ups and referential checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def enrich(events: DataFrame, dims: list[tuple[DataFrame, list[str], str]]) -> DataFrame:
    """Join each ``(dimension, keys, "inner" | "left")`` in turn.

    No side is hinted: Spark broadcasts a dimension whose measured size allows it and otherwise
    sort-merges, splitting skewed partitions of the event side.
    """
    for dim, keys, how in dims:
        events = events.join(dim, keys, how)
    return events


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child keys without a parent, with the number of child rows.

    Both sides are cut down to one row per key first, so a hot key reaches the join once.
    """
    counted = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    parents = parent.select(F.col(parent_column).alias(column)).distinct()
    return counted.join(parents, column, "left_anti")
