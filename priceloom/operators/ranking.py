"""Ranks within groups that may be too large for one task.

``rank() OVER (PARTITION BY group ORDER BY price)`` sends a whole group to one task. A rank only
depends on how many rows have a smaller price, so rows are counted per (group, price) first and the
counts are summed in two levels: over blocks of prices, then inside each block. A DECIMAL(p, s) price
bounds both levels, so no window partition grows with the data.

The counts and the ranks are written as small tables on the way. The rows themselves are read twice
and, as long as the rank table is small enough for a broadcast, never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql import types as T

from priceloom.operators.stats import gap_to_group_mean
from priceloom.session import settle


def _block_width(kind: T.DataType) -> float:
    if not isinstance(kind, T.DecimalType) or kind.precision > 12:
        raise TypeError("rank by a DECIMAL of at most 12 digits: ties need exact values")
    return 10.0 ** (kind.precision // 2 - kind.scale)


def _before(column: str, window: WindowSpec) -> Column:
    """Sum over the rows in front of the current one."""
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def ranks_of_counts(counted: DataFrame, by: list[str], value: str, count: str, ascending: str, descending: str) -> DataFrame:
    """One row per (group, price) with its count and its rank from either end, from rows that hold the counts."""
    width = _block_width(counted.schema[value].dataType)
    held = counted.select(*by, value, F.col(count).alias("_n"), F.floor(F.col(value) / F.lit(width)).alias("_block"))
    counts = settle(held, "counts")
    blocks = counts.groupBy(*by, "_block").agg(F.sum("_n").alias("_n")).select(
        *[F.col(c).alias(f"_b_{c}") for c in by],
        F.col("_block").alias("_b_block"),
        _before("_n", Window.partitionBy(*by).orderBy("_block")).alias("_smaller_blocks"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_total"),
    )
    same_block = F.col("_block") == F.col("_b_block")
    for c in by:
        same_block &= F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    inside = counts.withColumn("_smaller_inside", _before("_n", Window.partitionBy(*by, "_block").orderBy(value)))
    smaller = F.col("_smaller_blocks") + F.col("_smaller_inside")
    return inside.join(blocks, same_block).select(
        *by,
        value,
        F.col("_n").alias(count),
        (smaller + 1).alias(ascending),
        (F.col("_total") - smaller - F.col("_n") + 1).alias(descending),
    )


def price_ranks(df: DataFrame, by: list[str], value: str, ascending: str, descending: str) -> DataFrame:
    """One row per (group, price) with its rank from either end."""
    counted = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_count"))
    return ranks_of_counts(counted, by, value, "_count", ascending, descending).drop("_count")


def attach_ranks(df: DataFrame, ranks: DataFrame, by: list[str], value: str) -> DataFrame:
    """``df`` with the other columns of ``ranks``, by (group, price)."""
    keys = [*by, value]
    extra = [c for c in ranks.columns if c not in keys]
    right = settle(ranks, "ranks").select(*[F.col(c).alias(f"_r_{c}") for c in keys], *extra)
    same = F.lit(True)
    for c in keys:
        same &= F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return df.join(right, same).drop(*[f"_r_{c}" for c in keys])


def rank_in_group(
    df: DataFrame, by: list[str], value: str, ascending: str = "rank_asc", descending: str = "rank_desc"
) -> DataFrame:
    """``df`` with both ranks of ``value`` inside its group; ties share a rank and leave gaps."""
    ranks = price_ranks(df, by, value, ascending, descending)
    return attach_ranks(df, ranks, by, value)


def rank_with_gap(
    df: DataFrame,
    stats: DataFrame,
    by: list[str],
    value: str,
    mean: str,
    ascending: str = "rank_asc",
    descending: str = "rank_desc",
    gap: str = "gap",
) -> DataFrame:
    """Both ranks and the signed gap to the group's mean, a column of ``stats``.

    All three depend on (group, price) alone, so ``df`` itself is joined once.
    """
    ranks = price_ranks(df, by, value, ascending, descending)
    return attach_ranks(df, gap_to_group_mean(ranks, by, value, stats, mean, gap), by, value)


def top_n(
    df: DataFrame, by: list[str], value: str, n: int, smallest: bool = True, rank: str = "rank"
) -> DataFrame:
    """Rows whose rank is at most ``n``, ties included. Joins with at most ``n`` prices per group."""
    ascending, descending = (rank, "_other") if smallest else ("_other", rank)
    ranks = price_ranks(df, by, value, ascending, descending).filter(F.col(rank) <= n)
    return attach_ranks(df, ranks.drop("_other"), by, value)
