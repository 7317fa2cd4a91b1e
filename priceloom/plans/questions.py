"""The questions a dashboard asks of the marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from priceloom.functions import geo_label
from priceloom.operators.ranking import top_n
from priceloom.operators.stats import cheapest_groups, kpis
from priceloom.plans.marts import GROUP

DEFAULT_FUEL = "Gazole"


def only_fuel(df: DataFrame, fuel: str | None = DEFAULT_FUEL) -> DataFrame:
    """The dashboard's fuel selector; ``None`` keeps all."""
    return df if fuel is None else df.filter(F.col("carburant_nom") == fuel)


def cheapest_regions(stats: DataFrame, fuel: str | None = DEFAULT_FUEL) -> DataFrame:
    """Where is fuel cheapest? Regions by mean price, cheapest first."""
    return cheapest_groups(only_fuel(stats, fuel), "region_nom", "prix_moyen")


def station_map(latest: DataFrame, fuel: str | None = DEFAULT_FUEL) -> DataFrame:
    """Which stations are cheapest, and where? One labelled point per station."""
    return only_fuel(latest, fuel).withColumn("geo", geo_label(F.col("latitude"), F.col("longitude")))


def dispersion(stats: DataFrame, fuel: str | None = DEFAULT_FUEL) -> DataFrame:
    """How far do prices spread in each region?"""
    return only_fuel(stats, fuel).select(
        *GROUP, "prix_min", "prix_p25_approx", "prix_median_approx", "prix_p75_approx", "prix_max", "prix_ecart_type",
        (F.col("prix_max") - F.col("prix_min")).alias("etendue"),
    )


_BOARD = ["region_nom", "carburant_nom", "ville", "station_id", "prix_euro"]


def top_stations(ranking: DataFrame, n: int = 10, fuel: str | None = None) -> DataFrame:
    """The ``n`` cheapest per region and fuel, ties included, from the ranking mart."""
    shown = [*_BOARD, "rang_moins_cher_region", "ecart_prix_vs_moyenne_region"]
    return only_fuel(ranking, fuel).filter(F.col("rang_moins_cher_region") <= n).select(*shown)


def flop_stations(ranking: DataFrame, n: int = 10, fuel: str | None = None) -> DataFrame:
    """The ``n`` dearest per region and fuel, ties included."""
    shown = [*_BOARD, "rang_plus_cher_region", "ecart_prix_vs_moyenne_region"]
    return only_fuel(ranking, fuel).filter(F.col("rang_plus_cher_region") <= n).select(*shown)


def top_latest(latest: DataFrame, n: int = 10, cheapest: bool = True) -> DataFrame:
    """The same board straight from latest prices, without ranking every station."""
    return top_n(latest.filter("region_nom IS NOT NULL"), GROUP, "prix_euro", n, cheapest, "rang")


def headline(latest: DataFrame, fuel: str | None = DEFAULT_FUEL) -> DataFrame:
    """National mean, spread, number of stations and last update."""
    return kpis(only_fuel(latest, fuel), "station_sk", "prix_euro", "maj_timestamp_utc")


def change_frequency(fact: DataFrame) -> DataFrame:
    """Price changes per station: how many, on how many days, and per day."""
    per_station = fact.groupBy("station_sk").agg(
        F.count(F.lit(1)).alias("changes"),
        F.count_distinct("date_sk").alias("days"),
        F.min("maj_timestamp_utc").alias("first_change"),
        F.max("maj_timestamp_utc").alias("last_change"),
    )
    return per_station.withColumn("changes_per_day", F.round(F.col("changes") / F.col("days"), 6))


def inactive_stations(fact: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    """Stations with their last change, flagged active when it lies within ``days`` of ``as_of``."""
    limit = F.lit((as_of - dt.timedelta(days=days)).isoformat(sep=" ")).cast("timestamp_ntz")
    last = fact.groupBy("station_sk").agg(F.max("maj_timestamp_utc").alias("last_change"))
    return last.withColumn("est_active", F.col("last_change") >= limit)
