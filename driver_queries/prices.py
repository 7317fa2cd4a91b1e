"""Latest prices, regional statistics, ranks and headline figures.

A customer stands for a station, an event type for a fuel, an event for a published price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from driver_queries.registry import plain, query, table
from priceloom.contracts import PRICE
from priceloom.functions import geo_label
from priceloom.operators import (
    cheapest_groups,
    enrich,
    gap_to_group_mean,
    group_stats,
    kpis,
    pick_one,
    rank_in_group,
    rank_with_gap,
    top_n,
)
from priceloom.plans import marts, questions
from priceloom.session import settle

GROUP = marts.GROUP

LATEST = """
newest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn FROM events
  ) WHERE rn = 1
),
latest AS (
  SELECT e.user_id, e.event_type AS carburant_nom, CAST(e.value AS DECIMAL(10,3)) AS prix_euro,
         e.ts AS maj_timestamp_utc, n.n_name AS ville,
         CASE WHEN n.n_nationkey % 9 = 8 THEN NULL ELSE r.r_name END AS region_nom,
         CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE CAST(c.c_acctbal AS DECIMAL(12,2)) END AS latitude,
         c.c_nationkey AS longitude
  FROM newest e
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

STATS = """
stats AS (
  SELECT region_nom, carburant_nom, count(*) AS count_stations, avg(CAST(prix_euro AS DOUBLE)) AS prix_moyen,
         min(prix_euro) AS prix_min, max(prix_euro) AS prix_max,
         stddev_samp(CAST(prix_euro AS DOUBLE)) AS prix_ecart_type,
         quantile_disc(prix_euro, 0.25) AS prix_p25_approx, quantile_disc(prix_euro, 0.5) AS prix_median_approx,
         quantile_disc(prix_euro, 0.75) AS prix_p75_approx
  FROM latest WHERE region_nom IS NOT NULL GROUP BY ALL
)"""

RANKED = """
ranked AS (
  SELECT l.user_id, l.region_nom, l.carburant_nom, l.ville, l.prix_euro,
         rank() OVER (PARTITION BY l.region_nom, l.carburant_nom ORDER BY l.prix_euro) AS rang_moins_cher_region,
         rank() OVER (PARTITION BY l.region_nom, l.carburant_nom ORDER BY l.prix_euro DESC) AS rang_plus_cher_region,
         l.prix_euro - s.prix_moyen AS ecart_prix_vs_moyenne_region
  FROM latest l JOIN stats s ON s.region_nom = l.region_nom AND s.carburant_nom = l.carburant_nom
)"""


def dbl(*names: str) -> str:
    return ", ".join(f"round(CAST({n} AS DOUBLE), 6) AS {n}" for n in names)


def newest_prices(spark: SparkSession, folder: str) -> DataFrame:
    """The last event per user and type."""
    events = table(spark, folder, "events", "user_id", "event_type", "ts", "value", "event_id")
    newest = pick_one(events, ["user_id", "event_type"], [F.col("ts").desc()], tiebreak=["event_id"])
    return newest.select(
        "user_id",
        F.col("event_type").alias("carburant_nom"),
        F.col("value").cast(PRICE).alias("prix_euro"),
        F.col("ts").alias("maj_timestamp_utc"),
    )


def latest_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Newest prices with town, region and position; one nation in nine has no region."""
    customers = table(spark, folder, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    acctbal = F.col("c_acctbal").cast("decimal(12,2)")
    stations = customers.select(
        F.col("c_custkey").alias("user_id"),
        "c_nationkey",
        F.when(F.col("c_custkey") % 11 != 0, acctbal).alias("latitude"),
        F.col("c_nationkey").alias("longitude"),
    )
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("ville"), "n_regionkey"
    )
    regions = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    dims = [(stations, ["user_id"], "inner"), (nations, ["c_nationkey"], "inner"), (regions, ["n_regionkey"], "left")]
    return enrich(newest_prices(spark, folder), dims).select(
        "user_id", "carburant_nom", "prix_euro", "maj_timestamp_utc", "ville",
        F.when(F.col("c_nationkey") % 9 != 8, F.col("r_name")).alias("region_nom"),
        "latitude", "longitude",
    )


def in_region(spark: SparkSession, folder: str) -> DataFrame:
    return latest_prices(spark, folder).filter("region_nom IS NOT NULL")


@query(f"""WITH {LATEST}, {STATS}
SELECT region_nom, carburant_nom, count_stations, {dbl('prix_moyen', 'prix_min', 'prix_max', 'prix_ecart_type')}
FROM stats""")
def region_price_stats(spark: SparkSession, folder: str) -> DataFrame:
    names = {"count": "count_stations", "mean": "prix_moyen", "min": "prix_min", "max": "prix_max", "stddev": "prix_ecart_type"}
    return plain(group_stats(in_region(spark, folder), GROUP, "prix_euro", {}, names=names))


@query(f"""WITH {LATEST}, {STATS}
SELECT region_nom, carburant_nom, {dbl('prix_p25_approx', 'prix_median_approx', 'prix_p75_approx')} FROM stats""")
def region_price_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    stats = marts.region_stats(latest_prices(spark, folder))
    return plain(stats.select(*GROUP, "prix_p25_approx", "prix_median_approx", "prix_p75_approx"))


@query(f"""WITH {LATEST}, {STATS}
SELECT region_nom, carburant_nom,
       {dbl('prix_min', 'prix_p25_approx', 'prix_median_approx', 'prix_p75_approx', 'prix_max', 'prix_ecart_type')},
       round(CAST(prix_max - prix_min AS DOUBLE), 6) AS etendue FROM stats""")
def price_dispersion(spark: SparkSession, folder: str) -> DataFrame:
    return plain(questions.dispersion(marts.region_stats(latest_prices(spark, folder)), None))


@query(f"""WITH {LATEST}, {STATS}
SELECT region_nom, count_stations, {dbl('prix_moyen')} FROM stats WHERE carburant_nom = 'purchase'
ORDER BY prix_moyen, region_nom""")
def cheapest_regions(spark: SparkSession, folder: str) -> DataFrame:
    stats = marts.region_stats(questions.only_fuel(latest_prices(spark, folder), "purchase"))
    return plain(cheapest_groups(stats, "region_nom", "prix_moyen").select("region_nom", "count_stations", "prix_moyen"))


@query(f"""WITH {LATEST}
SELECT user_id, carburant_nom, ville, region_nom, {dbl('prix_euro')}, maj_timestamp_utc,
       CAST(latitude AS VARCHAR) || ', ' || CAST(longitude AS VARCHAR) AS geo
FROM latest""")
def latest_price_map(spark: SparkSession, folder: str) -> DataFrame:
    geo = geo_label(F.col("latitude"), F.col("longitude")).alias("geo")
    rows = latest_prices(spark, folder)
    return plain(rows.select("user_id", "carburant_nom", "ville", "region_nom", "prix_euro", "maj_timestamp_utc", geo))


@query("""SELECT user_id, event_type AS carburant_nom, round(CAST(value AS DOUBLE), 6) AS prix_euro,
       ts AS maj_timestamp_utc
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn FROM events)
WHERE rn = 1""")
def latest_event_per_pair(spark: SparkSession, folder: str) -> DataFrame:
    return plain(newest_prices(spark, folder))


@query(f"""WITH {LATEST}, {STATS}, {RANKED}
SELECT user_id, region_nom, carburant_nom, ville, {dbl('prix_euro', 'ecart_prix_vs_moyenne_region')},
       rang_moins_cher_region, rang_plus_cher_region FROM ranked""")
def station_price_rank(spark: SparkSession, folder: str) -> DataFrame:
    latest = settle(in_region(spark, folder), "latest")  # read by the statistics, the ranks and the result
    ranked = rank_with_gap(
        latest, marts.region_stats(latest), GROUP, "prix_euro", "prix_moyen",
        "rang_moins_cher_region", "rang_plus_cher_region", "ecart_prix_vs_moyenne_region",
    )
    return plain(ranked.select(
        "user_id", *GROUP, "ville", "prix_euro", "rang_moins_cher_region", "rang_plus_cher_region",
        "ecart_prix_vs_moyenne_region",
    ))


@query(f"""WITH {LATEST}, {STATS}, {RANKED}
SELECT user_id, region_nom, carburant_nom, {dbl('prix_euro')}, rang_moins_cher_region AS rang
FROM ranked WHERE rang_moins_cher_region <= 10""")
def station_price_top10(spark: SparkSession, folder: str) -> DataFrame:
    rows = questions.top_latest(settle(latest_prices(spark, folder), "latest"), 10)
    return plain(rows.select("user_id", *GROUP, "prix_euro", "rang"))


@query(f"""WITH {LATEST}, {STATS}, {RANKED}
SELECT user_id, region_nom, carburant_nom, {dbl('prix_euro')}, rang_plus_cher_region AS rang
FROM ranked WHERE rang_plus_cher_region <= 10""")
def station_price_flop10(spark: SparkSession, folder: str) -> DataFrame:
    rows = questions.top_latest(settle(latest_prices(spark, folder), "latest"), 10, cheapest=False)
    return plain(rows.select("user_id", *GROUP, "prix_euro", "rang"))


@query(f"""WITH {LATEST}, {STATS}
SELECT user_id, l.region_nom, l.carburant_nom, round(l.prix_euro - s.prix_moyen, 6) AS gap
FROM latest l JOIN stats s ON s.region_nom = l.region_nom AND s.carburant_nom = l.carburant_nom""")
def gap_to_region_mean(spark: SparkSession, folder: str) -> DataFrame:
    rows = gap_to_group_mean(settle(in_region(spark, folder), "latest"), GROUP, "prix_euro")
    return plain(rows.select("user_id", *GROUP, "gap"))


@query(f"""WITH {LATEST}
SELECT {dbl('mean_price', 'price_spread')}, entity_count, latest_update FROM (
  SELECT avg(CAST(prix_euro AS DOUBLE)) AS mean_price, max(prix_euro) - min(prix_euro) AS price_spread,
         count(DISTINCT user_id) AS entity_count, max(maj_timestamp_utc) AS latest_update
  FROM latest WHERE carburant_nom = 'purchase')""")
def price_kpis(spark: SparkSession, folder: str) -> DataFrame:
    rows = questions.only_fuel(latest_prices(spark, folder), "purchase")
    return plain(kpis(rows, "user_id", "prix_euro", "maj_timestamp_utc"))


@query("""SELECT event_id, event_type, rank() OVER (PARTITION BY event_type ORDER BY CAST(value AS DECIMAL(10,3))) AS rank_asc,
       rank() OVER (PARTITION BY event_type ORDER BY CAST(value AS DECIMAL(10,3)) DESC) AS rank_desc FROM events""")
def rank_all_events(spark: SparkSession, folder: str) -> DataFrame:
    """Both ranks over the raw events: five groups that hold the whole table."""
    events = table(spark, folder, "events", "event_id", "event_type", "value")
    ranked = rank_in_group(events.withColumn("value", F.col("value").cast(PRICE)), ["event_type"], "value")
    return ranked.select("event_id", "event_type", "rank_asc", "rank_desc")


@query("""SELECT l_orderkey, l_linenumber, l_returnflag, round(l_extendedprice, 6) AS l_extendedprice, rang FROM (
  SELECT *, rank() OVER (PARTITION BY l_returnflag ORDER BY CAST(l_extendedprice AS DECIMAL(12,2)) DESC) AS rang
  FROM lineitem) WHERE rang <= 10""")
def dearest_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Ten dearest order lines per return flag, ties included."""
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    lines = lines.withColumn("l_extendedprice", F.col("l_extendedprice").cast("decimal(12,2)"))
    return plain(top_n(lines, ["l_returnflag"], "l_extendedprice", 10, smallest=False, rank="rang"))


@query("""SELECT user_id, changes, days, first_change, last_change, round(changes / days, 6) AS changes_per_day FROM (
  SELECT user_id, count(*) AS changes, count(DISTINCT CAST(ts AS DATE)) AS days, min(ts) AS first_change,
         max(ts) AS last_change FROM events GROUP BY user_id)""")
def price_change_frequency(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events", "user_id", "ts")
    facts = events.select(
        F.col("user_id").alias("station_sk"), F.to_date("ts").alias("date_sk"), F.col("ts").alias("maj_timestamp_utc")
    )
    return questions.change_frequency(facts).withColumnRenamed("station_sk", "user_id")


@query("""SELECT user_id, max(ts) AS last_change, max(ts) >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 3 DAY AS est_active
FROM events GROUP BY user_id""")
def inactive_entities(spark: SparkSession, folder: str) -> DataFrame:
    import datetime as dt

    events = table(spark, folder, "events", "user_id", "ts")
    facts = events.select(F.col("user_id").alias("station_sk"), F.col("ts").alias("maj_timestamp_utc"))
    flags = questions.inactive_stations(facts, dt.datetime(2024, 1, 30), 3)
    return flags.withColumnRenamed("station_sk", "user_id")
