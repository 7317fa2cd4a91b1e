"""Where queries register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function under its own name, with its SQL counterpart if there is one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def spread(df: DataFrame) -> DataFrame:
    """Give Python work to all cores, however the table's files are cut."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, decimals and doubles rounded to six places."""

    def shown(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            return F.round(column.cast("double"), 6).alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema])
