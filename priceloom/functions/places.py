"""Places: postal codes and map labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def postal_department(cp: Column) -> Column:
    """Department code of a French postal code; null when it cannot be told."""
    overseas, corsica = cp.rlike("^9[78].{3}$"), cp.rlike("^20.{3}$")
    south = cp < "20200"
    return (
        F.when(overseas, F.left(cp, F.lit(3)))
        .when(corsica & south, "2A")
        .when(corsica, "2B")
        .when(F.length(cp) > 1, F.left(cp, F.lit(2)))
    )


def geo_label(latitude: Column, longitude: Column) -> Column:
    """``"lat, lon"`` for a map; null as soon as one coordinate is missing."""
    return F.concat(latitude.cast("string"), F.lit(", "), longitude.cast("string"))
