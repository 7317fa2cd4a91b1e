"""Change feeds and what follows them; what the build's gate refuses; repeats of the whole history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from driver_queries.feed import _land, many_stations, slotted
from driver_queries.incremental import WHOLE, Lake, days_of
from driver_queries.registry import plain, query, table
from driver_queries.silver import DEPTS, KEYED, OBSERVED, PLACES, SILVER, observed
from driver_queries.star import FACT, FACT_OUT, FUEL_ROWS
from priceloom.contracts import ContractError, guard_not_null
from priceloom.operators.merge import merge_by_key, read_feed, read_table
from priceloom.plans import dimensions, histogram
from priceloom.plans.build import BuildConfig, build, table_path
from priceloom.plans.fact import FactLog, fact_rows, read_fact
from priceloom.plans.silver import keyed_events, read_silver, silver_events, withdraw_events
from priceloom.quality import differing_partitions
from priceloom.session import fresh_path
from priceloom.sources import reference
from priceloom.sources.archives import FeedDriftError
from priceloom.sources.slots import ingest, read_bronze, slots_in, write_new_slots
from priceloom.storage import replace_table

# --- merges and their feeds --------------------------------------------------------------------------


def _orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders by month; what is offered: one in ten dearer and later, as many new; and one in ten to go."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_totalprice", "o_orderdate")
    month = lambda days: F.date_format(F.col("o_orderdate") + F.make_dt_interval(days=F.lit(days)), "yyyy-MM").alias("month")
    known = orders.select("o_orderkey", "o_totalprice", month(0))
    later = orders.filter("o_orderkey % 10 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), month(40))
    fresh = orders.filter("o_orderkey % 10 = 1").select((-F.col("o_orderkey") - 1).alias("o_orderkey"), "o_totalprice", month(0))
    return known, later.unionByName(fresh), orders.filter("o_orderkey % 10 = 2").select("o_orderkey")


def _merged(spark: SparkSession, folder: str) -> tuple[str, str, DataFrame]:
    """The folders of the table and of the feed after a merge that inserts, replaces and removes."""
    known, offered, gone = _orders(spark, folder)
    path, feed = fresh_path(spark, "orders"), fresh_path(spark, "feed")
    merge_by_key(path, known, "o_orderkey", "month")
    merge_by_key(path, offered, "o_orderkey", "month", removed=gone, feed=feed)
    return path, feed, known


@query("""WITH o AS (SELECT o_orderkey, o_totalprice AS p, strftime(o_orderdate, '%Y-%m') AS m, strftime(o_orderdate + INTERVAL 40 DAY, '%Y-%m') AS late FROM orders)
SELECT o_orderkey, 'update' AS action, m AS old_month, late AS new_month, round(p, 6) AS old_price, round(p + 1, 6) AS new_price FROM o WHERE o_orderkey % 10 = 0
UNION ALL SELECT -o_orderkey - 1, 'insert', NULL, m, NULL, round(p, 6) FROM o WHERE o_orderkey % 10 = 1
UNION ALL SELECT o_orderkey, 'delete', m, NULL, round(p, 6), NULL FROM o WHERE o_orderkey % 10 = 2""")
def merge_change_feed(spark: SparkSession, folder: str) -> DataFrame:
    """What a merge hands on: each changed key with its row and partition before and after."""
    _, feed, known = _merged(spark, folder)
    return plain(read_feed(spark, feed, known.schema, "o_orderkey", "month").select(
        "o_orderkey", "action", F.col("old_partition").alias("old_month"), F.col("partition").alias("new_month"),
        F.col("old.o_totalprice").alias("old_price"), F.col("new.o_totalprice").alias("new_price"),
    ))


@query("""SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE o_orderkey % 10 NOT IN (0, 2)
UNION ALL SELECT o_orderkey, round(o_totalprice + 1, 6), strftime(o_orderdate + INTERVAL 40 DAY, '%Y-%m') FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT -o_orderkey - 1, round(o_totalprice, 6), strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderkey % 10 = 1""")
def merge_with_removals(spark: SparkSession, folder: str) -> DataFrame:
    path, _, known = _merged(spark, folder)
    return plain(read_table(spark, path, known.schema))


# --- what follows the feeds --------------------------------------------------------------------------

# Stations whose events are withdrawn once everything is in.
_GONE = 17
_KEPT = f"""{OBSERVED}, {SILVER}, kept AS (SELECT * FROM silver WHERE CAST(station_id AS BIGINT) % {_GONE} <> 0),
{KEYED.replace('FROM silver', 'FROM kept')}, {FACT}"""
_LATEST = f"""{_KEPT}, {DEPTS}, {PLACES}, {FUEL_ROWS},
latest AS (SELECT p.region_nom, c.carburant_nom, f.prix_euro FROM (SELECT *, row_number() OVER (PARTITION BY station_sk, carburant_sk
    ORDER BY maj_timestamp_utc DESC) AS rn FROM fact) f
  JOIN places p ON p.localisation_sk = f.localisation_sk JOIN fuels c ON c.carburant_sk = f.carburant_sk
  WHERE rn = 1 AND p.region_nom IS NOT NULL)"""


class _Followed(Lake):
    """A lake whose counts of latest prices move on with every batch."""

    def __init__(self, spark: SparkSession) -> None:
        super().__init__(spark)
        self.latest, self.counts = (fresh_path(spark, n) for n in ("latest", "counts"))

    def count(self) -> DataFrame:
        places = dimensions.dim_localisation(read_silver(self.spark, self.silver), reference.departments(self.spark))
        fuels = dimensions.dim_carburant(reference.fuels(self.spark))
        log = FactLog(self.spark, self.fact)
        _, counts = histogram.advance_latest(self.spark, self.latest, self.counts, read_fact(self.spark, self.fact), log, places, fuels)
        return counts


def _after_corrections(spark: SparkSession, folder: str, follow=lambda lake: None) -> _Followed:
    """Half of the days without one, then the rest with the late one, which corrects sightings; then withdrawals."""
    rows, lake = slotted(spark, folder), _Followed(spark)
    late, middle = days_of(rows)
    for part in (rows.filter((F.col("dt") != late) & (F.col("dt") <= middle)), rows):
        lake.batch(part, "merge")
        follow(lake)
    events = read_silver(spark, lake.silver)
    withdraw_events(spark, lake.silver, events.filter(F.col("station_id").cast("bigint") % _GONE == 0).select("prix_sk"))
    lake.follow("merge")
    follow(lake)
    return lake


@query(f"WITH {_KEPT} SELECT {FACT_OUT} FROM fact")
def fact_follows_corrections(spark: SparkSession, folder: str) -> DataFrame:
    """The fact after a late day that corrects first sightings and after withdrawn events, by silver's feed alone."""
    return _after_corrections(spark, folder).result()


@query(f"""WITH {_LATEST} SELECT region_nom, carburant_nom, count(*) AS count_stations, round(avg(CAST(prix_euro AS DOUBLE)), 6) AS prix_moyen,
  round(CAST(min(prix_euro) AS DOUBLE), 6) AS prix_min, round(CAST(max(prix_euro) AS DOUBLE), 6) AS prix_max,
  round(stddev_samp(CAST(prix_euro AS DOUBLE)), 6) AS prix_ecart_type,
  round(CAST(quantile_disc(prix_euro, 0.25) AS DOUBLE), 6) AS prix_p25_approx, round(CAST(quantile_disc(prix_euro, 0.5) AS DOUBLE), 6) AS prix_median_approx,
  round(CAST(quantile_disc(prix_euro, 0.75) AS DOUBLE), 6) AS prix_p75_approx FROM latest GROUP BY ALL""")
def histogram_region_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Regional statistics from counts that followed late corrections and withdrawals, against all latest prices."""
    lake = _after_corrections(spark, folder, _Followed.count)
    return plain(histogram.stats_of_ranks(histogram.group_ranks(lake.count())))


@query(f"""WITH {_LATEST} SELECT DISTINCT region_nom, carburant_nom, round(CAST(prix_euro AS DOUBLE), 6) AS prix_euro,
  count(*) OVER (PARTITION BY region_nom, carburant_nom, prix_euro) AS stations,
  rank() OVER (PARTITION BY region_nom, carburant_nom ORDER BY prix_euro) AS rang_moins_cher_region,
  rank() OVER (PARTITION BY region_nom, carburant_nom ORDER BY prix_euro DESC) AS rang_plus_cher_region FROM latest""")
def histogram_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks from the same counts."""
    return plain(histogram.group_ranks(_after_corrections(spark, folder, _Followed.count).count()))


# --- parity ------------------------------------------------------------------------------------------


@query(f"""WITH {OBSERVED}, {SILVER}, {KEYED}, {FACT}, marked AS (SELECT ingestion_date, row_number() OVER (ORDER BY prix_sk) AS n FROM fact
  WHERE prix_euro NOT IN ((SELECT min(prix_euro) FROM fact), (SELECT max(prix_euro) FROM fact)))
SELECT CAST(ingestion_date AS VARCHAR) AS ingestion_date, count(*) AS left_rows, count(*) AS right_rows FROM fact
WHERE ingestion_date = (SELECT ingestion_date FROM marked WHERE n = 1) GROUP BY 1""")
def parity_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """One price is changed that leaves count, minimum and maximum alone: its ingestion date is named, no other."""
    full = fact_rows(keyed_events(silver_events(observed(spark, folder))))
    ends = full.agg(F.min("prix_euro"), F.max("prix_euro")).first()
    one = full.filter(~F.col("prix_euro").isin(*ends)).agg(F.min("prix_sk")).first()[0]
    step = F.when(F.col("prix_euro") + 1 < F.lit(ends[1]), F.lit(1)).otherwise(F.lit(-1)).cast("decimal(10,3)") / 1000
    moved = (F.col("prix_euro") + step).cast("decimal(10,3)")
    changed = full.withColumn("prix_euro", F.when(F.col("prix_sk") == one, moved).otherwise(F.col("prix_euro")))
    return plain(differing_partitions(full, changed, ["ingestion_date"]))


# --- the blocking half of the gate -------------------------------------------------------------------


@query("""WITH e AS (SELECT event_id % 5 AS part, event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS value FROM events),
parts AS (SELECT part, count(*) AS offered, count(*) FILTER (value IS NULL AND part % 2 = 1) AS nulls, count(*) FILTER (event_id % 2 = 0 AND value IS NOT NULL) AS before FROM e GROUP BY 1)
SELECT part, nulls > 0 AS refused, CASE WHEN nulls > 0 THEN before ELSE offered END AS stored_rows FROM parts""")
def gate_not_null(spark: SparkSession, folder: str) -> DataFrame:
    """NOT NULL at write: in every other of five tables the null is forbidden; a refused table keeps its old rows."""
    events = table(spark, folder, "events", "event_id", "value").select(
        "event_id", F.when(F.col("event_id") % 97 != 0, F.col("value")).alias("value")
    )
    report = None
    for part in range(5):
        path = fresh_path(spark, f"guarded-{part}")
        rows = events.filter(F.col("event_id") % 5 == part)
        replace_table(rows.filter("event_id % 2 = 0 AND value IS NOT NULL"), path)
        contract = rows.schema
        contract["value"].nullable = part % 2 == 0
        contract["event_id"].nullable = True
        refused = False
        try:
            replace_table(guard_not_null(rows, contract), path)
        except Exception as problem:  # the writing job stops; what else goes wrong must not pass for it
            if "NOT NULL violated: value" not in str(problem):
                raise
            refused = True
        found = spark.read.schema(rows.schema).parquet(path).agg(F.count(F.lit(1)).alias("stored_rows"))
        found = found.select(F.lit(part).cast("bigint").alias("part"), F.lit(refused).alias("refused"), "stored_rows")
        report = found if report is None else report.unionByName(found)
    return report


@query("SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, strftime(o_orderdate, '%Y-%m') AS month, 3 AS refused FROM orders")
def gate_schema_change(spark: SparkSession, folder: str) -> DataFrame:
    """A merge refuses a source with one column more, one less or one of another type, and leaves the table alone."""
    known, _, _ = _orders(spark, folder)
    path, refused = fresh_path(spark, "orders"), 0
    merge_by_key(path, known, "o_orderkey", "month")
    for other in (known.withColumn("more", F.lit(1)), known.drop("o_totalprice"), known.withColumn("o_totalprice", F.lit("1"))):
        try:
            merge_by_key(path, other, "o_orderkey", "month")
        except ContractError:
            refused += 1
    return plain(read_table(spark, path, known.schema).withColumn("refused", F.lit(refused)))


@query(f"""WITH {OBSERVED}, {SILVER}, {DEPTS}, {PLACES}, missing AS (SELECT count(*) AS n FROM places WHERE dept_code IS NOT NULL AND (dept_nom IS NULL OR dept_code LIKE '0%'))
SELECT node, failures, status FROM (VALUES ('dim_localisation', 'error'), ('dim_station', 'skipped'), ('int_prix_keyed', 'skipped'), ('fct_prix_carburant', 'skipped'),
  ('agg_dernier_prix_station_carburant', 'skipped'), ('agg_prix_region_carburant', 'skipped'), ('agg_classement_stations', 'skipped')) v(node, status),
  LATERAL (SELECT CASE WHEN status = 'error' THEN n ELSE 0 END AS failures FROM missing)""")
def gate_skipped_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """With departments missing from the reference data the locations fail, and all that needs them is skipped."""
    csv = fresh_path(spark, "departments")
    reference.departments(spark).filter("dept_code NOT LIKE '0%'").coalesce(1).write.option("header", True).csv(csv)
    bronze = fresh_path(spark, "bronze")
    write_new_slots(slotted(spark, folder), bronze)
    cfg = BuildConfig(bronze, fresh_path(spark, "warehouse"), as_of=dt.datetime(2100, 1, 1), departments_csv=csv)
    report = build(spark, cfg, strict=False)
    return report.filter("status NOT IN ('pass', 'warn')").select("node", "failures", "status")


# --- the whole history again -------------------------------------------------------------------------


@query(WHOLE)
def full_refresh_build(spark: SparkSession, folder: str) -> DataFrame:
    """A day that came late is missing from the fact until a full refresh builds silver and the fact from all slots."""
    rows = slotted(spark, folder)
    late, _ = days_of(rows)
    cfg = BuildConfig(fresh_path(spark, "bronze"), fresh_path(spark, "warehouse"), as_of=dt.datetime(2100, 1, 1))
    for part, whole in ((rows.filter(F.col("dt") != late), False), (rows, True)):
        write_new_slots(part, cfg.bronze_root, slots_in(part))
        build(spark, BuildConfig(cfg.bronze_root, cfg.warehouse, as_of=cfg.as_of, full_refresh=whole))
    return plain(read_fact(spark, table_path(cfg.warehouse, "fct_prix_carburant")))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS station_id, substr(o_orderpriority, 1, 1) AS carburant_id, round(round(o_totalprice, 2), 6) AS prix_euro,
  '2026-05-' || lpad(CAST(1 + o_orderkey % 28 AS VARCHAR), 2, '0') AS dt, lpad(CAST(o_orderkey % 4 AS VARCHAR), 2, '0') AS hh, true AS same
FROM orders WHERE o_orderkey % 28 % 9 <> 4""")
def replay_second_root(spark: SparkSession, folder: str) -> DataFrame:
    """The archives stay where they are: an empty second root takes the whole history again, row for row."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    raw, roots = fresh_path(spark, "landed"), [fresh_path(spark, n) for n in ("first", "second")]
    _land(many_stations(orders), raw)
    for root in roots:
        try:
            ingest(spark, raw, root)
        except FeedDriftError:
            pass  # the truncated archives are refused both times
    first, second = (read_bronze(spark, root) for root in roots)
    same = differing_partitions(first, second, ["dt", "hh"]).isEmpty()
    return plain(second.select("station_id", "carburant_id", "prix_euro", "dt", "hh", F.lit(same).alias("same")))
