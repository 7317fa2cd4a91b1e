"""Strict high watermarks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from priceloom.fixed_values import FIRST_WATERMARK


def high_watermark(target: DataFrame | None, column: str, default: str = FIRST_WATERMARK) -> dt.datetime:
    """Greatest ``column`` of the target, read once; ``default`` for a missing or empty target."""
    first = dt.datetime.fromisoformat(default)
    if target is None:
        return first
    found = target.agg(F.max(column).alias("wm")).first()["wm"]
    return first if found is None else found


def after(df: DataFrame, column: str, watermark: dt.datetime) -> DataFrame:
    """Rows strictly above the watermark, compared with a literal so that the filter reaches the scan."""
    return df.filter(F.col(column) > F.lit(watermark.isoformat(sep=" ")).cast("timestamp_ntz"))
