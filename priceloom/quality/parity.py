"""Comparing two builds of the same table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from priceloom.contracts import ContractError, contract_problems
from priceloom.operators.key_counts import two_hashes
from priceloom.sources.profile import audit


def profile(df: DataFrame, measures: list[str], keys: list[str]) -> DataFrame:
    """DataFrame[metric, value]: row count, min and max of measures, distinct keys."""
    row = audit(df, measures, keys)
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in row.columns]
    return row.select(F.inline(F.array(*pairs)))


def compare_builds(a: DataFrame, b: DataFrame, measures: list[str], keys: list[str]) -> DataFrame:
    """DataFrame[metric, left_value, right_value, same], one row per metric."""
    left = profile(a, measures, keys).withColumnRenamed("value", "left_value")
    right = profile(b, measures, keys).withColumnRenamed("value", "right_value")
    same = F.col("left_value").eqNullSafe(F.col("right_value"))
    return left.join(right, "metric", "full").withColumn("same", same)


def fingerprint(df: DataFrame, by: list[str]) -> DataFrame:
    """DataFrame[*by, row_count, one, two]: the content of each partition, in any order of its rows.

    ``one`` and ``two`` add up two hashes of whole rows, so a repeated row counts as often as it occurs.
    Columns are taken by name. Every task sends one row per partition it has seen.
    """
    one, two = two_hashes([F.col(f"`{c}`") for c in sorted(df.columns)])
    total = lambda h: F.sum(h.cast("decimal(38,0)"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), total(one).alias("one"), total(two).alias("two"))


def differing_partitions(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """DataFrame[*by, left_rows, right_rows]: the partitions whose content differs, however little.

    Each side is read once. Raises when their columns differ.
    """
    problems = contract_problems(a, b.schema)
    if problems:
        raise ContractError("; ".join(f"{name}: {what}" for name, what in problems))
    prints = [fingerprint(side, by).select(*by, F.struct("row_count", "one", "two").alias(n)) for side, n in ((a, "left"), (b, "right"))]
    both = prints[0].unionByName(prints[1], allowMissingColumns=True).groupBy(*by)
    held = both.agg(*[F.max(n).alias(n) for n in ("left", "right")])
    rows = [F.coalesce(F.col(f"{n}.row_count"), F.lit(0)).alias(f"{n}_rows") for n in ("left", "right")]
    return held.filter(~F.col("left").eqNullSafe(F.col("right"))).select(*by, *rows)
