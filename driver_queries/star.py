"""The star schema and its marts, from observed snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from driver_queries.feed import slotted
from driver_queries.registry import plain, query
from driver_queries.silver import DEPTS, KEYED, OBSERVED, PLACES, SILVER, STATIONS, silver, sk, values
from priceloom.fixed_values import FUELS
from priceloom.plans import dimensions, marts, questions
from priceloom.plans.build import BuildConfig, build, table_path
from priceloom.plans.fact import fact_rows
from priceloom.plans.silver import keyed_events
from priceloom.session import fresh_path, settle
from priceloom.sources import reference
from priceloom.sources.slots import write_new_slots

FACT = """
fact AS (SELECT prix_sk, station_sk, carburant_sk, date_sk, localisation_sk, CAST(prix_euro AS DECIMAL(10,3)) AS prix_euro,
  maj_timestamp_utc, ingestion_ts, CAST(ingestion_ts AS DATE) AS ingestion_date FROM keyed)"""
FACT_OUT = """prix_sk, station_sk, carburant_sk, date_sk, localisation_sk, round(CAST(prix_euro AS DOUBLE), 6) AS prix_euro,
  maj_timestamp_utc, ingestion_ts, CAST(ingestion_date AS VARCHAR) AS ingestion_date"""
FUEL_ROWS = f"""{values(FUELS, 'fuel_rows', 'carburant_id, carburant_nom, carburant_libelle_long')},
fuels AS (SELECT {sk('carburant_id')} AS carburant_sk, * FROM fuel_rows)"""
MART = """
mart AS (
  SELECT f.station_sk, f.carburant_sk, c.carburant_id, c.carburant_nom, f.prix_euro, f.maj_timestamp_utc,
         s.station_id, s.latitude, s.longitude, s.cp, s.ville, l.dept_code, l.dept_nom, l.region_nom
  FROM (SELECT *, row_number() OVER (PARTITION BY station_sk, carburant_sk
          ORDER BY maj_timestamp_utc DESC, localisation_sk, prix_euro) AS rn FROM fact) f
  JOIN stations s ON s.station_sk = f.station_sk
  JOIN fuels c ON c.carburant_sk = f.carburant_sk
  LEFT JOIN places l ON l.localisation_sk = f.localisation_sk
  WHERE rn = 1
)"""
REGIONS = """
regions AS (
  SELECT region_nom, carburant_nom, count(*) AS count_stations, avg(CAST(prix_euro AS DOUBLE)) AS prix_moyen
  FROM mart WHERE region_nom IS NOT NULL GROUP BY ALL
)"""
ALL_TABLES = f"{OBSERVED}, {SILVER}, {DEPTS}, {PLACES}, {STATIONS}, {FUEL_ROWS}, {KEYED}, {FACT}, {MART}, {REGIONS}"
RANKING_OUT = """SELECT m.station_id, m.carburant_id, m.carburant_nom, m.region_nom, m.dept_nom, m.dept_code, m.ville, m.cp,
  round(m.latitude, 6) AS latitude, round(m.longitude, 6) AS longitude, round(CAST(m.prix_euro AS DOUBLE), 6) AS prix_euro,
  rank() OVER (PARTITION BY m.region_nom, m.carburant_nom ORDER BY m.prix_euro) AS rang_moins_cher_region,
  rank() OVER (PARTITION BY m.region_nom, m.carburant_nom ORDER BY m.prix_euro DESC) AS rang_plus_cher_region,
  round(m.prix_euro - r.prix_moyen, 6) AS ecart_prix_vs_moyenne_region
FROM mart m JOIN regions r ON r.region_nom = m.region_nom AND r.carburant_nom = m.carburant_nom"""
_RANKING_COLUMNS = [
    "station_id", "carburant_id", "carburant_nom", "region_nom", "dept_nom", "dept_code", "ville", "cp", "latitude",
    "longitude", "prix_euro", "rang_moins_cher_region", "rang_plus_cher_region", "ecart_prix_vs_moyenne_region",
]


def mart(spark: SparkSession, folder: str) -> DataFrame:
    """Latest prices from the dimensions and the fact, silver being written once."""
    events = settle(silver(spark, folder), "silver")
    return marts.latest_prices(
        fact_rows(keyed_events(events)),
        dimensions.dim_station(events),
        dimensions.dim_carburant(reference.fuels(spark)),
        dimensions.dim_localisation(events, reference.departments(spark)),
    )


@query(f"WITH {OBSERVED}, {SILVER}, {KEYED}, {FACT} SELECT {FACT_OUT} FROM fact")
def fact_full_build(spark: SparkSession, folder: str) -> DataFrame:
    return plain(fact_rows(keyed_events(silver(spark, folder))))


@query(f"""WITH {ALL_TABLES} SELECT station_sk, carburant_id, carburant_nom, round(CAST(prix_euro AS DOUBLE), 6) AS prix_euro,
  maj_timestamp_utc, station_id, cp, ville, dept_code, dept_nom, region_nom FROM mart""")
def star_join(spark: SparkSession, folder: str) -> DataFrame:
    return plain(mart(spark, folder).drop("carburant_sk", "latitude", "longitude"))


@query(f"""WITH {ALL_TABLES}, named AS (SELECT region_nom, carburant_nom, count(*) AS stations FROM mart GROUP BY ALL)
SELECT n.region_nom, n.carburant_nom, c.carburant_libelle_long, n.stations FROM named n
JOIN fuel_rows c ON c.carburant_nom = n.carburant_nom""")
def dashboard_relations(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard's join of a mart with the fuel dimension on the fuel's name."""
    named = mart(spark, folder).groupBy(*marts.GROUP).agg(F.count(F.lit(1)).alias("stations"))
    fuels = dimensions.dim_carburant(reference.fuels(spark)).select("carburant_nom", "carburant_libelle_long")
    return named.join(fuels, "carburant_nom")


@query(f"""WITH {ALL_TABLES} SELECT m.station_id, m.region_nom, m.carburant_nom, c.carburant_libelle_long, r.count_stations,
  round(r.prix_moyen, 6) AS prix_moyen
FROM mart m LEFT JOIN regions r ON r.region_nom = m.region_nom AND r.carburant_nom = m.carburant_nom
JOIN fuel_rows c ON c.carburant_nom = m.carburant_nom""")
def dashboard_mart_relations(spark: SparkSession, folder: str) -> DataFrame:
    """The latest prices joined with the regions' statistics on (region, fuel), and with the fuel dimension."""
    latest = settle(mart(spark, folder), "mart")
    regions = marts.region_stats(latest).select(*marts.GROUP, "count_stations", "prix_moyen")
    fuels = dimensions.dim_carburant(reference.fuels(spark)).select("carburant_nom", "carburant_libelle_long")
    joined = latest.select("station_id", *marts.GROUP).join(regions, marts.GROUP, "left").join(fuels, "carburant_nom")
    return plain(joined)


def built(spark: SparkSession, folder: str) -> tuple[DataFrame, BuildConfig]:
    """All of bronze written as daily slots, then the gated build of every table."""
    bronze = fresh_path(spark, "bronze")
    write_new_slots(slotted(spark, folder), bronze)
    cfg = BuildConfig(bronze, fresh_path(spark, "warehouse"), as_of=dt.datetime(2100, 1, 1))
    return build(spark, cfg), cfg


@query(f"WITH {ALL_TABLES} {RANKING_OUT}")
def gated_build_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking mart at the end of the whole gated build."""
    _, cfg = built(spark, folder)
    return plain(spark.read.parquet(table_path(cfg.warehouse, "agg_classement_stations")).select(*_RANKING_COLUMNS))


@query(f"""WITH {ALL_TABLES}, counts AS (
  SELECT (SELECT count(*) FROM fact WHERE NOT prix_euro BETWEEN 0.5 AND 3.5) AS fact_warns,
         (SELECT count(*) FROM mart WHERE NOT prix_euro BETWEEN 0.5 AND 3.5) AS mart_warns,
         (SELECT count(*) FROM regions WHERE NOT prix_moyen BETWEEN 0.5 AND 3.5) AS region_warns,
         (SELECT count(*) FROM stations WHERE NOT latitude BETWEEN 41 AND 52) AS latitude_warns,
         (SELECT count(*) FROM stations WHERE NOT longitude BETWEEN -5 AND 10) AS longitude_warns)
SELECT node, "column", failures FROM (
  SELECT unnest(['stg_prix', 'fct_prix_carburant', 'agg_dernier_prix_station_carburant', 'agg_prix_region_carburant', 'dim_station', 'dim_station']) AS node,
         unnest(['prix_euro', 'prix_euro', 'prix_euro', 'prix_moyen', 'latitude', 'longitude']) AS "column",
         unnest([fact_warns, fact_warns, mart_warns, region_warns, latitude_warns, longitude_warns]) AS failures FROM counts) WHERE failures > 0""")
def gated_build_warnings(spark: SparkSession, folder: str) -> DataFrame:
    """What the gated build reports: prices and coordinates outside the usual range; all else passes."""
    report, _ = built(spark, folder)
    return report.filter("status <> 'pass'").select("node", "column", "failures")


@query(f"""WITH {ALL_TABLES} SELECT station_id, region_nom, carburant_nom, round(CAST(prix_euro AS DOUBLE), 6) AS prix_euro, rang
FROM (SELECT *, rank() OVER (PARTITION BY region_nom, carburant_nom ORDER BY prix_euro) AS rang
      FROM mart WHERE region_nom IS NOT NULL) WHERE rang <= 10""")
def star_top10(spark: SparkSession, folder: str) -> DataFrame:
    rows = questions.top_latest(settle(mart(spark, folder), "mart"), 10)
    return plain(rows.select("station_id", *marts.GROUP, "prix_euro", "rang"))
