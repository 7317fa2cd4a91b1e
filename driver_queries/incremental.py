"""Watermarks, merges, late slots, streams, replays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from driver_queries.feed import slotted
from driver_queries.registry import plain, query, table
from driver_queries.silver import KEYED, OBSERVED, SILVER, observed
from driver_queries.star import FACT, FACT_OUT
from priceloom.operators import after, high_watermark, merge_by_key
from priceloom.plans.fact import fact_rows, follow_silver, read_fact
from priceloom.plans.silver import fold_new_slots, keyed_events, read_silver, silver_events
from priceloom.quality import compare_builds
from priceloom.session import fresh_path
from priceloom.sources.slots import slots_in, write_new_slots
from priceloom.streaming import build_stream

WHOLE = f"WITH {OBSERVED}, {SILVER}, {KEYED}, {FACT} SELECT {FACT_OUT} FROM fact"


class Lake:
    """Bronze, silver and fact in folders of their own."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.bronze, self.silver, self.fact, self.checkpoint = (
            fresh_path(spark, n) for n in ("bronze", "silver", "fact", "stream")
        )

    def batch(self, rows: DataFrame, late: str = "drop") -> None:
        write_new_slots(rows, self.bronze, slots_in(rows))
        fold_new_slots(self.spark, self.bronze, self.silver)
        self.follow(late)

    def follow(self, late: str) -> None:
        follow_silver(self.spark, self.silver, self.fact, late=late)

    def stream(self, rows: DataFrame, late: str) -> None:
        write_new_slots(rows, self.bronze)
        query = build_stream(self.spark, self.bronze, self.silver, self.fact, self.checkpoint, late)
        query.awaitTermination()

    def result(self) -> DataFrame:
        return plain(read_fact(self.spark, self.fact))


def days_of(rows: DataFrame) -> tuple[str, str]:
    """A day early in the feed, and one in its middle."""
    first = dt.date.fromisoformat(rows.agg(F.min("dt")).first()[0])
    return tuple((first + dt.timedelta(days=n)).isoformat() for n in (4, 14))


@query("""SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id % 3 = 0 AND ts < (
  SELECT min(ts) + INTERVAL 10 DAY FROM events))""")
def incremental_watermark(spark: SparkSession, folder: str) -> DataFrame:
    """Rows strictly above the newest one already held."""
    events = table(spark, folder, "events", "event_id", "ts")
    limit = events.agg(F.min("ts").alias("t")).first()["t"] + dt.timedelta(days=10)
    held = events.filter((F.col("event_id") % 3 == 0) & (F.col("ts") < F.lit(limit.isoformat(sep=" ")).cast("timestamp_ntz")))
    return after(events, "ts", high_watermark(held, "ts"))


@query("""SELECT o_orderkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, strftime(o_orderdate, '%Y-%m') AS month
  FROM orders WHERE o_orderkey % 10 <> 0
UNION ALL SELECT o_orderkey, 'X', round(o_totalprice + 1, 6), strftime(o_orderdate + INTERVAL 40 DAY, '%Y-%m') FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT -o_orderkey - 1, 'N', round(o_totalprice, 6), strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderkey % 10 = 1""")
def upsert_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by month: one in ten changes and moves to a later month, as many arrive new."""
    path = fresh_path(spark, "orders")
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    month = lambda days: F.date_format(F.col("o_orderdate") + F.make_dt_interval(days=F.lit(days)), "yyyy-MM")
    target = orders.withColumn("month", month(0)).drop("o_orderdate")
    changed = orders.filter("o_orderkey % 10 = 0").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"), month(40).alias("month"))
    fresh = orders.filter("o_orderkey % 10 = 1").select(
        (-F.col("o_orderkey") - 1).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice", month(0).alias("month"))
    merge_by_key(path, target, "o_orderkey", "month")
    for _ in range(2):  # the second merge changes nothing
        merge_by_key(path, changed.unionByName(fresh), "o_orderkey", "month")
    return plain(spark.read.schema(target.schema).parquet(path))


@query(WHOLE)
def incremental_build(spark: SparkSession, folder: str) -> DataFrame:
    """The fact after two increments and a rerun equals the full build."""
    rows, lake = slotted(spark, folder), Lake(spark)
    _, middle = days_of(rows)
    for part in (rows.filter(F.col("dt") <= middle), rows, rows):
        lake.batch(part)
    return lake.result()


# First seen while the late day was missing, then over everything.
_LATE = f"""WITH {OBSERVED}, days AS (SELECT min(ingestion_ts) + INTERVAL 4 DAY AS late, min(ingestion_ts) + INTERVAL 14 DAY AS middle FROM observed),
{SILVER.replace('silver AS', 'everything AS')},
{SILVER.replace('silver AS', 'early AS').replace('FROM observed', 'FROM observed, days WHERE ingestion_ts <> late AND ingestion_ts <= middle').replace('SELECT * REPLACE', 'SELECT * EXCLUDE (late, middle) REPLACE')},
silver AS (SELECT * FROM early UNION ALL SELECT * FROM everything e WHERE NOT EXISTS (SELECT 1 FROM early x WHERE x.prix_sk = e.prix_sk)
  AND e.ingestion_ts > (SELECT max(ingestion_ts) FROM early)),
{KEYED}, {FACT} SELECT {FACT_OUT} FROM fact"""


def _late_parts(rows: DataFrame) -> list[DataFrame]:
    late, middle = days_of(rows)
    return [rows.filter((F.col("dt") != late) & (F.col("dt") <= middle)), rows]


@query(_LATE)
def late_data_drop(spark: SparkSession, folder: str) -> DataFrame:
    """A day that arrives late stays out of the fact, unless later days showed the event in time."""
    rows, lake = slotted(spark, folder), Lake(spark)
    for part in _late_parts(rows):
        lake.batch(part)
    return lake.result()


@query(f"""WITH {OBSERVED}, {SILVER} SELECT prix_sk, station_id, carburant_id, maj_timestamp_utc, ingestion_ts FROM silver""")
def late_data_in_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Stored silver takes a late day in as if it had come in time."""
    rows, lake = slotted(spark, folder), Lake(spark)
    for part in _late_parts(rows):
        write_new_slots(part, lake.bronze)
        fold_new_slots(spark, lake.bronze, lake.silver)
    return read_silver(spark, lake.silver).select("prix_sk", "station_id", "carburant_id", "maj_timestamp_utc", "ingestion_ts")


@query(WHOLE)
def stream_build_merge_late(spark: SparkSession, folder: str) -> DataFrame:
    """Micro-batches that let a late day in end at the full build."""
    rows, lake = slotted(spark, folder), Lake(spark)
    for part in _late_parts(rows):
        lake.stream(part, "merge")
    return lake.result()


@query(_LATE)
def stream_build_drop_late(spark: SparkSession, folder: str) -> DataFrame:
    rows, lake = slotted(spark, folder), Lake(spark)
    for part in _late_parts(rows):
        lake.stream(part, "drop")
    return lake.result()


@query(WHOLE)
def stream_build_small_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A few files a batch, in any order: the result is that of the whole build."""
    lake = Lake(spark)
    write_new_slots(slotted(spark, folder).repartition(16), lake.bronze)
    build_stream(
        spark, lake.bronze, lake.silver, lake.fact, fresh_path(spark, "checkpoint"), "drop", files_per_batch=5
    ).awaitTermination()
    return lake.result()


@query(f"""WITH {OBSERVED}, {SILVER}, {KEYED}, {FACT}, profile AS (
  SELECT count(*) AS row_count, min(prix_euro) AS prix_euro_min, max(prix_euro) AS prix_euro_max, count(DISTINCT prix_sk) AS distinct_prix_sk,
         count(DISTINCT station_sk) AS distinct_station_sk, count(DISTINCT date_sk) AS distinct_date_sk FROM fact)
SELECT metric, value AS left_value, value AS right_value, true AS same FROM (
  SELECT unnest(['row_count', 'prix_euro_min', 'prix_euro_max', 'distinct_prix_sk', 'distinct_station_sk', 'distinct_date_sk']) AS metric,
         unnest([CAST(row_count AS VARCHAR), CAST(prix_euro_min AS VARCHAR), CAST(prix_euro_max AS VARCHAR),
                 CAST(distinct_prix_sk AS VARCHAR), CAST(distinct_station_sk AS VARCHAR), CAST(distinct_date_sk AS VARCHAR)]) AS value FROM profile)""")
def parity_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The incremental fact against the full build, metric by metric."""
    rows, lake = slotted(spark, folder), Lake(spark)
    _, middle = days_of(rows)
    for part in (rows.filter(F.col("dt") <= middle), rows):
        lake.batch(part)
    full = fact_rows(keyed_events(silver_events(observed(spark, folder))))
    return compare_builds(read_fact(spark, lake.fact), full, ["prix_euro"], ["prix_sk", "station_sk", "date_sk"])
