"""Repeated snapshots to events: dedup, keys, clocks, places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from driver_queries.registry import plain, query, table
from priceloom.fixed_values import DEPARTMENTS, FUELS, KEY_NULL_TOKEN, MONTHS_FR, WEEKDAYS_FR
from priceloom.contracts import conform, require
from priceloom.functions import (
    business_day,
    clean_text,
    date_key,
    fixed_point,
    local_to_utc,
    micros_to_ts,
    postal_department,
    price,
    strict_ts,
    surrogate_key,
    utc_instant,
)
from priceloom.operators import calendar, distinct_members, duplicate_keys, pick_one
from priceloom.plans import dimensions
from priceloom.plans.silver import keyed_events, silver_events
from priceloom.session import fresh_path
from priceloom.sources import reference

# Event types in the order of the fuel ids they stand for.
TYPES = ["click", "error", "purchase", "signup", "view"]


def sk(*columns: str) -> str:
    """The surrogate key in SQL."""
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{KEY_NULL_TOKEN}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def _case(position: int) -> str:
    arms = " ".join(f"WHEN '{t}' THEN '{FUELS[i][position]}'" for i, t in enumerate(TYPES))
    return f"CASE event_type {arms} ELSE '{FUELS[5][position]}' END"


def values(rows: list[tuple], name: str, columns: str) -> str:
    quoted = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows)
    return f"{name}({columns}) AS (VALUES {quoted})"


# An event is seen in one to three daily snapshots, the first one the day after it happened.
OBSERVED = f"""
observed AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS station_id,
         CASE WHEN user_id % 29 = 0 THEN NULL WHEN user_id % 23 = 0 THEN '97400'
              ELSE lpad(CAST((user_id % 95 + 1) * 1000 + user_id % 997 AS VARCHAR), 5, '0') END AS cp,
         'V' || CAST(user_id % 40 AS VARCHAR) AS ville, 'rue ' || CAST(event_id % 10 AS VARCHAR) AS adresse,
         CASE WHEN user_id % 3 = 0 THEN 'A' ELSE 'R' END AS pop,
         41 + (user_id % 1000) / CAST(100 AS DOUBLE) AS latitude,
         -4 + (user_id % 1300) / CAST(100 AS DOUBLE) AS longitude,
         {_case(0)} AS carburant_id, {_case(1)} AS carburant_nom, ts AS maj_timestamp, value AS prix_euro,
         CAST(date_trunc('day', ts) AS TIMESTAMP) + (k + 1) * INTERVAL 1 DAY AS ingestion_ts, 'feed' AS source_url
  FROM events, range(3) r(k) WHERE k <= event_id % 3
)"""

SILVER = f"""
silver AS (
  SELECT {sk('station_id', 'carburant_id', 'maj_timestamp_utc')} AS prix_sk, * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY station_id, carburant_id, maj_timestamp_utc ORDER BY ingestion_ts,
        adresse, carburant_nom, cp NULLS FIRST, latitude, longitude, pop, prix_euro, source_url, ville) AS rn
    FROM (SELECT * REPLACE (CAST(prix_euro AS DECIMAL(10,3)) AS prix_euro),
                 (maj_timestamp AT TIME ZONE 'Europe/Paris') AT TIME ZONE 'UTC' AS maj_timestamp_utc FROM observed)
  ) WHERE rn = 1
)"""

DEPTS = values(DEPARTMENTS, "departments", "dept_code, dept_nom, region_nom")
DEPT_OF = """CASE WHEN regexp_matches(cp, '^9[78]...$') THEN left(cp, 3)
  WHEN regexp_matches(cp, '^20...$') THEN if(cp < '20200', '2A', '2B') WHEN length(cp) > 1 THEN left(cp, 2) END"""
PLACES = f"""
places AS (
  SELECT {sk('cp', 'ville')} AS localisation_sk, p.*, d.dept_nom, d.region_nom
  FROM (SELECT DISTINCT cp, ville, {DEPT_OF} AS dept_code FROM silver) p
  LEFT JOIN departments d ON d.dept_code = p.dept_code
)"""
STATIONS = f"""
stations AS (
  SELECT {sk('station_id')} AS station_sk, {sk('cp', 'ville')} AS localisation_sk,
         station_id, cp, ville, adresse, pop, latitude, longitude
  FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ingestion_ts DESC,
          adresse, cp NULLS FIRST, latitude, longitude, pop, ville) AS rn FROM silver) WHERE rn = 1
)"""
KEYED = f"""
keyed AS (
  SELECT prix_sk, {sk('station_id')} AS station_sk, {sk('carburant_id')} AS carburant_sk,
         {sk('cp', 'ville')} AS localisation_sk,
         CAST(strftime((maj_timestamp_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris', '%Y%m%d') AS INTEGER) AS date_sk,
         maj_timestamp_utc, prix_euro, ingestion_ts FROM silver
)"""


def observed(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze rows: each event in the daily snapshots that show it."""
    user, event = F.col("user_id"), F.col("event_id")
    fuel = lambda position: F.coalesce(
        *[F.when(F.col("event_type") == t, FUELS[i][position]) for i, t in enumerate(TYPES)], F.lit(FUELS[5][position])
    )
    number = ((user % 95 + 1) * 1000 + user % 997).cast("string")
    cp = F.when(user % 29 == 0, None).when(user % 23 == 0, "97400").otherwise(F.lpad(number, 5, "0"))
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    events = table(spark, folder, "events", "event_id", "user_id", "event_type", "ts", "value")
    return events.withColumn("k", F.explode(F.sequence(F.lit(0), (event % 3).cast("int")))).select(
        user.cast("string").alias("station_id"),
        cp.alias("cp"),
        F.concat(F.lit("V"), (user % 40).cast("string")).alias("ville"),
        F.concat(F.lit("rue "), (event % 10).cast("string")).alias("adresse"),
        F.when(user % 3 == 0, "A").otherwise("R").alias("pop"),
        (41 + (user % 1000) / 100).alias("latitude"),
        (-4 + (user % 1300) / 100).alias("longitude"),
        fuel(0).alias("carburant_id"),
        fuel(1).alias("carburant_nom"),
        F.col("ts").alias("maj_timestamp"),
        F.col("value").alias("prix_euro"),
        (day + F.make_dt_interval(days=F.col("k") + 1)).alias("ingestion_ts"),
        F.lit("feed").alias("source_url"),
    )


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return silver_events(observed(spark, folder))


SILVER_OUT = """prix_sk, station_id, cp, ville, adresse, pop, round(latitude, 6) AS latitude,
  round(longitude, 6) AS longitude, carburant_id, carburant_nom, maj_timestamp_utc,
  round(CAST(prix_euro AS DOUBLE), 6) AS prix_euro, ingestion_ts, source_url"""


@query(f"WITH {OBSERVED}, {SILVER} SELECT {SILVER_OUT} FROM silver")
def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    return plain(silver(spark, folder))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity, 6) AS l_quantity, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_quantity, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_first_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return plain(pick_one(lines, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").asc()]))


@query("""SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def entity_latest_attrs(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return pick_one(orders, ["o_custkey"], [F.col("o_orderdate").desc()], tiebreak=["o_orderkey"])


@query("""SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(table(spark, folder, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("""SELECT event_id, user_id, event_type, round(value, 6) AS value FROM (
  SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type, value FROM events)
WHERE user_id IS NOT NULL AND event_type IS NOT NULL""")
def required_columns(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events", "event_id", "user_id", "event_type", "value")
    holes = events.withColumn("user_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")))
    holes = holes.withColumn("event_type", F.when(F.col("event_id") % 11 != 0, F.col("event_type")))
    return plain(require(holes, ["user_id", "event_type"]))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS INTEGER) AS customer,
       round(CAST(CAST(o_totalprice AS DECIMAL(12,1)) AS DOUBLE), 6) AS total, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
FROM orders""")
def typed_projection(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    named = orders.toDF("order_id", "customer", "total", "day", "status")
    from pyspark.sql import types as T

    contract = T.StructType.fromDDL("order_id string, customer int, total decimal(12,1), day date")
    return plain(conform(named, contract))


@query(f"""SELECT event_id, {sk('user_id', 'event_type', 'ts')} AS full_key,
  {sk("CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN '' ELSE event_type END", 'user_id')} AS gap_key FROM events""")
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events", "event_id", "user_id", "event_type", "ts")
    kind = F.when(F.col("event_id") % 5 == 0, None).when(F.col("event_id") % 5 == 1, "").otherwise(F.col("event_type"))
    return events.select(
        "event_id", surrogate_key("user_id", "event_type", "ts").alias("full_key"), surrogate_key(kind, "user_id").alias("gap_key")
    )


@query("""SELECT o_orderkey, (o_orderdate AT TIME ZONE 'Europe/Paris') AT TIME ZONE 'UTC' AS utc FROM orders""")
def order_time_in_utc(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", local_to_utc(F.col("o_orderdate")).alias("utc"))


@query("""SELECT event_id, CAST(strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris', '%Y%m%d') AS INTEGER) AS date_sk
FROM events""")
def business_day_key(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", date_key(business_day(F.col("ts"))).alias("date_sk"))


@query(f"""WITH {OBSERVED}, {SILVER}, {KEYED} SELECT prix_sk, station_sk, carburant_sk, localisation_sk, date_sk FROM keyed""")
def foreign_keys(spark: SparkSession, folder: str) -> DataFrame:
    keyed = keyed_events(silver(spark, folder))
    return keyed.select("prix_sk", "station_sk", "carburant_sk", "localisation_sk", "date_sk")


def _label(names: list[str], position: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names, 1))
    return f"CASE {position} {arms} END"


@query(f"""WITH placed AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM placed), (SELECT max(day) FROM placed), INTERVAL 1 DAY)) AS DATE) AS d),
moons AS (SELECT y, (19 * (y % 19) + 24) % 30 AS d FROM (SELECT DISTINCT year(d) AS y FROM spine)),
weeks AS (SELECT y, d, (2 * (y % 4) + 4 * (y % 7) + 6 * d + 5) % 7 AS e FROM moons),
easters AS (SELECT y, make_date(y, 3, 22) + CAST(d + e - CASE WHEN d = 29 AND e = 6 OR d = 28 AND e = 6 AND y % 19 > 10 THEN 7 ELSE 0 END AS INTEGER) AS sunday FROM weeks)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, CAST(d AS VARCHAR) AS full_date, year(d) AS year, quarter(d) AS quarter,
       isodow(d) < 6 AND strftime(d, '%d %b') NOT IN ('01 Jan', '01 May', '08 May', '14 Jul', '15 Aug', '01 Nov', '11 Nov', '25 Dec')
         AND date_diff('day', sunday, d) NOT IN (1, 39, 50) AS is_working_day,
       month(d) AS month, {_label(MONTHS_FR, 'month(d)')} AS month_name_fr, day(d) AS day_of_month,
       isodow(d) AS day_of_week, {_label(WEEKDAYS_FR, 'isodow(d)')} AS day_name_fr, week(d) AS iso_week,
       isodow(d) >= 6 AS is_weekend, coalesce(orders, 0) AS orders
FROM spine JOIN easters ON easters.y = year(spine.d) LEFT JOIN placed ON placed.day = spine.d""")
def calendar_dim(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar over the days on which orders were placed, with their number."""
    import datetime as dt

    placed = table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count(F.lit(1)).alias("orders"))
    first, last = placed.agg(F.min("full_date"), F.max("full_date")).first()
    days = calendar(spark, first, last + dt.timedelta(days=1))
    return plain(days.join(placed, "full_date", "left").fillna(0, ["orders"]))


@query(f"""SELECT c_custkey, {DEPT_OF.replace('cp', 'code')} AS dept FROM (
  SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN CAST(c_custkey % 10 AS VARCHAR)
    WHEN 3 THEN CAST(20000 + c_custkey % 400 AS VARCHAR) WHEN 4 THEN CAST(97000 + c_custkey * 37 % 2000 AS VARCHAR)
    ELSE lpad(CAST(c_custkey * 7919 % 100000 AS VARCHAR), 5, '0') END AS code FROM customer)""")
def postal_departments(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    code = (
        F.when(key % 6 == 1, "")
        .when(key % 6 == 2, (key % 10).cast("string"))
        .when(key % 6 == 3, (20000 + key % 400).cast("string"))
        .when(key % 6 == 4, (97000 + key * 37 % 2000).cast("string"))
        .when(key % 6 == 5, F.lpad((key * 7919 % 100000).cast("string"), 5, "0"))
    )
    return table(spark, folder, "customer").select("c_custkey", postal_department(code).alias("dept"))


@query(f"""WITH {OBSERVED}, {SILVER}, {DEPTS}, {PLACES}
SELECT localisation_sk, cp, ville, dept_code, dept_nom, region_nom FROM places""")
def location_dim(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_localisation(silver(spark, folder), reference.departments(spark))


@query(f"""WITH {OBSERVED}, {SILVER}, {STATIONS}
SELECT station_sk, localisation_sk, station_id, cp, ville, adresse, pop, round(latitude, 6) AS latitude,
       round(longitude, 6) AS longitude FROM stations""")
def station_dim(spark: SparkSession, folder: str) -> DataFrame:
    return plain(dimensions.dim_station(silver(spark, folder)))


@query(f"""WITH {values(FUELS, 'fuels', 'carburant_id, carburant_nom, carburant_libelle_long')}, {OBSERVED}
SELECT {sk('f.carburant_id')} AS carburant_sk, f.carburant_id, f.carburant_nom, carburant_libelle_long, count(*) AS sightings
FROM fuels f JOIN observed o ON o.carburant_id = f.carburant_id GROUP BY ALL""")
def fuel_dim(spark: SparkSession, folder: str) -> DataFrame:
    """The fuel dimension with the number of sightings of each fuel."""
    fuels = dimensions.dim_carburant(reference.fuels(spark))
    seen = observed(spark, folder).groupBy("carburant_id").agg(F.count(F.lit(1)).alias("sightings"))
    return seen.join(fuels, "carburant_id")


@query("""SELECT DISTINCT n_name, c_mktsegment FROM (
  SELECT CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END AS key, c_mktsegment FROM customer)
LEFT JOIN nation ON n_nationkey = key""")
def distinct_pairs(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    customers = customers.withColumn("n_nationkey", F.when(F.col("c_custkey") % 13 != 0, F.col("c_nationkey")))
    nations = table(spark, folder, "nation", "n_nationkey", "n_name")
    named = distinct_members(customers, ["n_nationkey", "c_mktsegment"]).join(nations, "n_nationkey", "left")
    return distinct_members(named, ["n_name", "c_mktsegment"])


@query("""SELECT event_id, ts AS seen FROM events""")
def epoch_micros_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Timestamps written to Parquet as plain microsecond counts (BIGINT) and read back with scale six."""
    path = fresh_path(spark, "micros")
    stored = table(spark, folder, "events").select("event_id", F.unix_micros(utc_instant(F.col("ts"))).alias("micros"))
    stored.write.parquet(path)
    return spark.read.schema("event_id bigint, micros bigint").parquet(path).select("event_id", micros_to_ts(F.col("micros")).alias("seen"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_path_extract(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey,
  CASE l_suppkey % 4 WHEN 0 THEN NULL ELSE round(l_extendedprice, 3) END AS amount,
  CASE l_suppkey % 4 WHEN 0 THEN NULL ELSE round(-l_partkey / CAST(100000 AS DOUBLE), 6) END AS coordinate,
  CASE l_suppkey % 3 WHEN 0 THEN NULL ELSE l_shipdate END AS shipped,
  CASE l_suppkey % 5 WHEN 0 THEN NULL ELSE l_returnflag END AS flag FROM lineitem""")
def raw_text_to_values(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines written as feed text, some of it damaged, and read back."""
    lines = table(spark, folder, "lineitem")
    supplier = F.col("l_suppkey")
    amount = F.when(supplier % 4 == 0, "n/a").otherwise(F.concat(F.lit(" "), F.col("l_extendedprice").cast("decimal(12,2)").cast("string")))
    coordinate = F.when(supplier % 4 == 0, "").otherwise((-F.col("l_partkey")).cast("string"))
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    shipped = F.when(supplier % 3 == 0, F.concat(shipped, F.lit("Z"))).otherwise(shipped)
    flag = F.when(supplier % 5 == 0, " \t").otherwise(F.concat(F.lit(" "), "l_returnflag", F.lit("\n")))
    return plain(lines.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        price(amount).alias("amount"), fixed_point(coordinate).alias("coordinate"),
        strict_ts(shipped).alias("shipped"), clean_text(flag).alias("flag"),
    ))
