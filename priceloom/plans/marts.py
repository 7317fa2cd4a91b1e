"""Aggregate marts over the latest prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from priceloom.operators.joins import enrich
from priceloom.operators.picking import pick_one
from priceloom.operators.ranking import rank_with_gap
from priceloom.operators.stats import group_stats

GROUP = ["region_nom", "carburant_nom"]
RANKING = [
    "station_sk", "station_id", "carburant_id", "carburant_nom", "region_nom", "dept_nom", "dept_code", "ville",
    "cp", "latitude", "longitude", "prix_euro", "maj_timestamp_utc", "rang_moins_cher_region",
    "rang_plus_cher_region", "ecart_prix_vs_moyenne_region",
]


def latest_prices(fact: DataFrame, stations: DataFrame, fuels: DataFrame, places: DataFrame) -> DataFrame:
    """The most recently published price per station and fuel.

    "Recent" follows the source's update time, not the time of capture. Town and coordinates are the
    station's current ones, the region is that of the place recorded with the price.
    """
    columns = ["station_sk", "carburant_sk", "localisation_sk", "prix_euro", "maj_timestamp_utc"]
    latest = pick_one(fact.select(*columns), ["station_sk", "carburant_sk"], [F.col("maj_timestamp_utc").desc()])
    return enrich(
        latest,
        [
            (stations.select("station_sk", "station_id", "latitude", "longitude", "cp", "ville"), ["station_sk"], "inner"),
            (fuels.select("carburant_sk", "carburant_id", "carburant_nom"), ["carburant_sk"], "inner"),
            (places.select("localisation_sk", "dept_code", "dept_nom", "region_nom"), ["localisation_sk"], "left"),
        ],
    ).select(
        "station_sk", "carburant_sk", "carburant_id", "carburant_nom", "prix_euro", "maj_timestamp_utc",
        "station_id", "latitude", "longitude", "cp", "ville", "dept_code", "dept_nom", "region_nom",
    )


def region_stats(latest: DataFrame) -> DataFrame:
    """Price statistics per region and fuel, over latest prices only."""
    return group_stats(
        latest.filter("region_nom IS NOT NULL"),
        GROUP,
        "prix_euro",
        quantiles={"prix_p25_approx": 0.25, "prix_median_approx": 0.5, "prix_p75_approx": 0.75},
        names={
            "count": "count_stations", "mean": "prix_moyen", "min": "prix_min", "max": "prix_max",
            "stddev": "prix_ecart_type",
        },
    )


def station_ranking(latest: DataFrame, stats: DataFrame) -> DataFrame:
    """Cheapest and dearest rank per region and fuel, with the gap to the regional mean."""
    return rank_with_gap(
        latest.filter("region_nom IS NOT NULL"), stats, GROUP, "prix_euro", "prix_moyen",
        "rang_moins_cher_region", "rang_plus_cher_region", "ecart_prix_vs_moyenne_region",
    ).select(*RANKING)
