"""How old is the newest row?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from priceloom.fixed_values import FRESH_ERROR_MINUTES, FRESH_WARN_MINUTES
from priceloom.functions import utc_wall_clock


def freshness(
    df: DataFrame,
    column: str,
    as_of: dt.datetime,
    warn: int = FRESH_WARN_MINUTES,
    error: int = FRESH_ERROR_MINUTES,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """One row [max_loaded_at, age_minutes, status] at ``as_of``, a UTC clock reading.

    Older than ``warn`` minutes warns, older than ``error`` minutes or an empty source fails. With
    ``by``, one row per source named in those columns.
    """
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    loaded = F.max(column)
    if df.schema[column].dataType == T.TimestampType():
        loaded = utc_wall_clock(loaded)
    newest = df.groupBy(*by).agg(loaded.alias("max_loaded_at"))
    age = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now) / 60_000_000
    status = (
        F.when(F.col("max_loaded_at").isNull() | (F.col("age_minutes") > error), "error")
        .when(F.col("age_minutes") > warn, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_minutes", age).withColumn("status", status)
