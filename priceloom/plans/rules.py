"""The checks declared for each table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from priceloom.contracts import PRICE
from priceloom.fixed_values import (
    FUELS,
    LATITUDE_HIGH,
    LATITUDE_LOW,
    LONGITUDE_HIGH,
    LONGITUDE_LOW,
    MONTHS_FR,
    PLACE_KINDS,
    PRICE_HIGH,
    PRICE_LOW,
)
from priceloom.quality.checks import Check, accepted, holds, not_after, not_null, refers_to, unique

FUEL_IDS = [f[0] for f in FUELS]
FUEL_NAMES = [f[1] for f in FUELS]


def _price(column: str = "prix_euro") -> Check:
    """Outside the usual range the source is suspect, the build is not."""
    return holds(column, f"between {PRICE_LOW} and {PRICE_HIGH}", "warn")


def _fits_gold(column: str = "prix_euro") -> Check:
    """What fails here is left out of the fact."""
    return Check("fits_gold", (column,), "warn", F.col(column).isNotNull() & F.col(column).try_cast(PRICE).isNull())


def for_format() -> list[Check]:
    """Slots whose update times are written otherwise than before; a reader may misunderstand them."""
    return [Check("format_drift", ("maj",), "warn", F.col("drifted"))]


def for_fuel_seed() -> list[Check]:
    return [
        not_null("carburant_id"), unique("carburant_id"), not_null("carburant_nom"), unique("carburant_nom"),
        not_null("carburant_libelle_long"),
    ]


def for_department_seed() -> list[Check]:
    return [
        not_null("dept_code"), unique("dept_code"), not_null("dept_nom"), unique("dept_nom"), not_null("region_nom"),
    ]


def for_silver() -> list[Check]:
    return [
        not_null("prix_sk"), unique("prix_sk"), not_null("station_id"), not_null("carburant_id"),
        accepted("carburant_id", FUEL_IDS), not_null("carburant_nom"), accepted("carburant_nom", FUEL_NAMES),
        not_null("maj_timestamp_utc"), not_null("prix_euro"), _price(), _fits_gold(), not_null("ingestion_ts"),
        unique("station_id", "carburant_id", "maj_timestamp_utc"),
    ]


def _foreign_keys(stations: DataFrame, fuels: DataFrame, days: DataFrame, places: DataFrame) -> list[Check]:
    return [
        refers_to("station_sk", stations, "station_sk"), refers_to("carburant_sk", fuels, "carburant_sk"),
        refers_to("date_sk", days, "date_sk"), refers_to("localisation_sk", places, "localisation_sk"),
    ]


def for_keyed(stations: DataFrame, fuels: DataFrame, days: DataFrame, places: DataFrame) -> list[Check]:
    return [
        not_null("prix_sk"), unique("prix_sk"), not_null("station_sk"), not_null("carburant_sk"),
        not_null("date_sk"), not_null("localisation_sk"), not_null("maj_timestamp_utc"), not_null("prix_euro"),
        *_foreign_keys(stations, fuels, days, places),
    ]


def for_dim_carburant() -> list[Check]:
    return [
        unique("carburant_sk"), unique("carburant_id"), accepted("carburant_id", FUEL_IDS),
        accepted("carburant_nom", FUEL_NAMES),
    ]


def for_dim_date() -> list[Check]:
    return [
        unique("date_sk"), unique("full_date"), accepted("month", list(range(1, 13))),
        accepted("month_name_fr", MONTHS_FR), accepted("day_of_week", list(range(1, 8))),
    ]


def for_dim_localisation(departments: DataFrame) -> list[Check]:
    return [unique("localisation_sk"), refers_to("dept_code", departments, "dept_code")]


def for_dim_station(places: DataFrame) -> list[Check]:
    return [
        unique("station_sk"), refers_to("localisation_sk", places, "localisation_sk"), unique("station_id"),
        *for_station_plausibility(),
    ]


def for_station_plausibility() -> list[Check]:
    """Documented expectations on stations; they warn."""
    return [
        holds("latitude", f"between {LATITUDE_LOW} and {LATITUDE_HIGH}", "warn"),
        holds("longitude", f"between {LONGITUDE_LOW} and {LONGITUDE_HIGH}", "warn"),
        accepted("pop", PLACE_KINDS, "warn"),
    ]


def for_fact(
    stations: DataFrame, fuels: DataFrame, days: DataFrame, places: DataFrame, as_of: Column
) -> list[Check]:
    return [
        unique("prix_sk"), *_foreign_keys(stations, fuels, days, places), _price(),
        not_after("maj_timestamp_utc", as_of),
    ]


def for_latest() -> list[Check]:
    return [
        not_null("station_sk"), not_null("carburant_sk"), not_null("carburant_nom"),
        accepted("carburant_nom", FUEL_NAMES), not_null("prix_euro"), _price(), not_null("maj_timestamp_utc"),
        unique("station_sk", "carburant_sk"),
    ]


def for_region_stats(departments: DataFrame) -> list[Check]:
    return [
        not_null("region_nom"), refers_to("region_nom", departments, "region_nom"), not_null("carburant_nom"),
        accepted("carburant_nom", FUEL_NAMES), not_null("count_stations"), holds("count_stations", "> 0"),
        not_null("prix_moyen"), _price("prix_moyen"), not_null("prix_min"), not_null("prix_max"),
        unique("region_nom", "carburant_nom"),
    ]


def for_ranking() -> list[Check]:
    return [
        not_null("station_sk"), not_null("region_nom"), not_null("carburant_nom"), not_null("prix_euro"),
        not_null("rang_moins_cher_region"), holds("rang_moins_cher_region", ">= 1"),
        not_null("ecart_prix_vs_moyenne_region"),
    ]
