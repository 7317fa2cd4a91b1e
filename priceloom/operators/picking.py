"""One row per key, distinct members, repeated keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def pick_one(
    df: DataFrame, keys: list[str], order_by: list[Column], tiebreak: list[str] | None = None
) -> DataFrame:
    """The first row of each key under ``order_by``.

    All other columns are appended to the order, so equal ``order_by`` values still give one defined
    winner. Filtering ``row_number`` on 1 lets Spark cut every map task down to one row per key before
    the shuffle, so a key that holds a third of all rows sends one row per task.
    """
    if tiebreak is None:
        tiebreak = sorted(c for c in df.columns if c not in keys)
    window = Window.partitionBy(*keys).orderBy(*order_by, *[F.col(c).asc() for c in tiebreak])
    return df.withColumn("_row_num", F.row_number().over(window)).filter("_row_num = 1").drop("_row_num")


def distinct_members(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct combinations of ``columns``; nulls form a member of their own."""
    return df.select(*columns).distinct()


def duplicate_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
