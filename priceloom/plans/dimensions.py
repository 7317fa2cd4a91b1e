"""The four dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from priceloom.contracts import DIM_CARBURANT, DIM_LOCALISATION, DIM_STATION, conform
from priceloom.functions import postal_department, surrogate_key
from priceloom.operators.calendar import calendar
from priceloom.operators.picking import distinct_members, pick_one


def dim_carburant(fuels: DataFrame) -> DataFrame:
    return conform(fuels.withColumn("carburant_sk", surrogate_key("carburant_id")), DIM_CARBURANT)


def dim_date(spark: SparkSession) -> DataFrame:
    return calendar(spark)


def dim_localisation(silver: DataFrame, departments: DataFrame) -> DataFrame:
    """Distinct (cp, ville) with department and region; a code without a department keeps null names."""
    places = (
        distinct_members(silver, ["cp", "ville"])
        .withColumn("localisation_sk", surrogate_key("cp", "ville"))
        .withColumn("dept_code", postal_department(F.col("cp")))
    )
    return conform(places.join(departments, "dept_code", "left"), DIM_LOCALISATION)


def dim_station(silver: DataFrame) -> DataFrame:
    """Latest known attributes per station (overwritten, no history)."""
    columns = ["station_id", "cp", "ville", "adresse", "pop", "latitude", "longitude"]
    latest = pick_one(silver.select(*columns, "ingestion_ts"), ["station_id"], [F.col("ingestion_ts").desc()])
    keyed = latest.withColumn("station_sk", surrogate_key("station_id"))
    return conform(keyed.withColumn("localisation_sk", surrogate_key("cp", "ville")), DIM_STATION)
