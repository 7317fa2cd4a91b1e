"""Group statistics, gaps to a mean, headline figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from priceloom.contracts import MEASURE
from priceloom.session import settle


def exact_mean(value: Column) -> Column:
    """Mean of a DECIMAL price with nine decimals."""
    return F.avg(value.cast("decimal(20,5)")).cast(MEASURE)


def group_stats(
    df: DataFrame,
    by: list[str],
    value: str,
    quantiles: dict[str, float] | None = None,
    accuracy: int = 10_000,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Count, mean, min, max, sample deviation and approximate quantiles per group in one shuffle.

    ``quantiles`` maps output column to fraction; ``names`` renames the five fixed measures. Every
    measure merges partial results, so groups of any size cost one row per task.
    """
    quantiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75} if quantiles is None else quantiles
    named = {k: (names or {}).get(k, k) for k in ("count", "mean", "min", "max", "stddev")}
    price = F.col(value)
    measures = [
        F.count(F.lit(1)).alias(named["count"]),
        exact_mean(price).alias(named["mean"]),
        F.min(price).alias(named["min"]),
        F.max(price).alias(named["max"]),
        F.stddev_samp(price).cast(MEASURE).alias(named["stddev"]),
    ]
    if quantiles:
        measures.append(F.percentile_approx(price, list(quantiles.values()), accuracy).alias("_q"))
    stats = df.groupBy(*by).agg(*measures)
    for position, column in enumerate(quantiles):
        stats = stats.withColumn(column, F.col("_q")[position])
    return stats.drop("_q")


def gap_to_group_mean(
    df: DataFrame, by: list[str], value: str, stats: DataFrame | None = None, mean: str = "mean", gap: str = "gap"
) -> DataFrame:
    """``df`` with the signed distance of ``value`` to its group's mean.

    The means, one row per group, are written first unless ``stats`` is given, so that the planner
    knows their size and need not shuffle ``df``.
    """
    if stats is None:
        stats = settle(df.groupBy(*by).agg(exact_mean(F.col(value)).alias(mean)), "means")
    means = stats.select(*by, F.col(mean).alias("_mean"))
    return df.join(means, by).withColumn(gap, (F.col(value) - F.col("_mean")).cast(MEASURE)).drop("_mean")


def cheapest_groups(stats: DataFrame, group: str, mean: str = "mean") -> DataFrame:
    """Groups in ascending order of their mean price."""
    return stats.orderBy(F.col(mean).asc(), F.col(group).asc())


def kpis(df: DataFrame, entity: str, value: str, ts: str) -> DataFrame:
    """One row: mean price, spread, number of distinct entities, latest update."""
    price = F.col(value)
    return df.agg(
        exact_mean(price).alias("mean_price"),
        (F.max(price) - F.min(price)).alias("price_spread"),
        F.count_distinct(F.col(entity)).alias("entity_count"),
        F.max(ts).alias("latest_update"),
    )
