"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from priceloom.fixed_values import KEY_NULL_TOKEN, KEY_SEPARATOR


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the text forms of the columns; a null and an empty text give different keys."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(p.cast("string"), F.lit(KEY_NULL_TOKEN)) for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))
