"""Every check, on rows with planted defects."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from driver_queries.registry import plain, query, table
from priceloom.contracts import contract_problems
from priceloom.operators import orphans
from priceloom.quality import accepted, failing_rows, freshness, holds, not_after, not_null, refers_to, run_checks, unique

# One event in 97 has no price, one in 31 an unknown type, one in 41 somebody else's id.
_EVENTS = """e AS (SELECT CASE WHEN event_id % 41 = 0 AND event_id > 0 THEN event_id - 1 ELSE event_id END AS event_id,
  CASE WHEN event_id % 53 = 0 THEN -1 - user_id ELSE user_id END AS user_id,
  CASE WHEN event_id % 31 = 0 THEN 'odd' WHEN event_id % 37 = 0 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS value, ts FROM events)"""
TYPES = ["click", "error", "purchase", "signup", "view"]
_NOW = "2024-01-25 00:00:00"


def damaged(spark: SparkSession, folder: str) -> DataFrame:
    event = F.col("event_id")
    return table(spark, folder, "events", "event_id", "user_id", "event_type", "value", "ts").select(
        F.when((event % 41 == 0) & (event > 0), event - 1).otherwise(event).alias("event_id"),
        F.when(event % 53 == 0, -1 - F.col("user_id")).otherwise(F.col("user_id")).alias("user_id"),
        F.when(event % 31 == 0, "odd").when(event % 37 == 0, None).otherwise(F.col("event_type")).alias("event_type"),
        F.when(event % 97 != 0, F.col("value")).alias("value"),
        "ts",
    )


def now():
    return F.lit(_NOW).cast("timestamp_ntz")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer", "c_custkey")


@query(f"WITH {_EVENTS} SELECT event_id, user_id FROM e WHERE value IS NULL")
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return failing_rows(damaged(spark, folder), not_null("value")).select("event_id", "user_id")


@query(f"WITH {_EVENTS} SELECT event_id, count(*) AS row_count FROM e GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return failing_rows(damaged(spark, folder), unique("event_id"))


@query(f"""WITH {_EVENTS} SELECT user_id, event_type, count(*) AS row_count FROM e GROUP BY ALL HAVING count(*) > 1""")
def dq_unique_combination(spark: SparkSession, folder: str) -> DataFrame:
    return failing_rows(damaged(spark, folder), unique("user_id", "event_type"))


@query(f"""WITH {_EVENTS} SELECT user_id, count(*) AS row_count FROM e WHERE user_id NOT IN (SELECT c_custkey FROM customer) GROUP BY 1""")
def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    return orphans(damaged(spark, folder), "user_id", customers(spark, folder), "c_custkey")


@query(f"WITH {_EVENTS} SELECT event_id, event_type FROM e WHERE event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view')")
def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    return failing_rows(damaged(spark, folder), accepted("event_type", TYPES)).select("event_id", "event_type")


@query(f"WITH {_EVENTS} SELECT event_id, round(value, 6) AS value FROM e WHERE NOT value BETWEEN 0.5 AND 3.5")
def dq_expression(spark: SparkSession, folder: str) -> DataFrame:
    rows = failing_rows(damaged(spark, folder), holds("value", "between 0.5 and 3.5", "warn"))
    return plain(rows.select("event_id", "value"))


@query(f"WITH {_EVENTS} SELECT event_id, ts FROM e WHERE ts > TIMESTAMP '{_NOW}'")
def dq_no_future(spark: SparkSession, folder: str) -> DataFrame:
    return failing_rows(damaged(spark, folder), not_after("ts", now())).select("event_id", "ts")


def _line(name: str, column: str, severity: str, failures: str) -> str:
    return f"""SELECT '{name}' AS "check", '{column}' AS "column", '{severity}' AS severity, ({failures}) AS failures"""


_CHECKS = " UNION ALL ".join([
    _line("not_null", "value", "error", "SELECT count(*) FROM e WHERE value IS NULL"),
    _line("not_null", "ts", "error", "SELECT count(*) FROM e WHERE ts IS NULL"),
    _line("accepted_values", "event_type", "error", "SELECT count(*) FROM e WHERE event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view')"),
    _line("expression: between 0.5 and 3.5", "value", "warn", "SELECT count(*) FROM e WHERE NOT value BETWEEN 0.5 AND 3.5"),
    _line("not_in_future", "ts", "error", f"SELECT count(*) FROM e WHERE ts > TIMESTAMP '{_NOW}'"),
    _line("unique", "event_id", "error", "SELECT count(*) FROM (SELECT event_id FROM e GROUP BY 1 HAVING count(*) > 1)"),
    _line("unique_combination", "event_id,event_type,ts", "error", "SELECT count(*) FROM (SELECT 1 FROM e GROUP BY event_id, event_type, ts HAVING count(*) > 1)"),
    _line("relationships", "user_id", "error", "SELECT count(*) FROM e WHERE user_id NOT IN (SELECT c_custkey FROM customer)"),
])


@query(f"""WITH {_EVENTS} SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'error' END AS status
FROM ({_CHECKS})""")
def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    checks = [
        not_null("value"), not_null("ts"), accepted("event_type", TYPES), holds("value", "between 0.5 and 3.5", "warn"),
        not_after("ts", now()), unique("event_id"), unique("event_id", "event_type", "ts"),
        refers_to("user_id", customers(spark, folder), "c_custkey"),
    ]
    return run_checks(damaged(spark, folder), checks)


@query("""SELECT * FROM (VALUES ('event_id', 'expected int, found bigint'), ('extra', 'extra'), ('region', 'missing')) t("column", problem),
  (SELECT event_type, count(*) AS refused_rows FROM events GROUP BY 1)""")
def dq_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Events held against a contract they break in three ways, with the rows per type this refuses."""
    contract = T.StructType.fromDDL("event_id int, user_id bigint, event_type string, value double, ts timestamp_ntz, region string")
    events = table(spark, folder, "events").drop("props").withColumn("extra", F.lit(1))
    problems = F.array(*[
        F.struct(F.lit(column).alias("column"), F.lit(problem).alias("problem"))
        for column, problem in contract_problems(events, contract)
    ])
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("refused_rows"))
    return counts.select("event_type", "refused_rows", F.inline(problems))


@query("""SELECT event_type, latest, age_minutes, CASE WHEN age_minutes > 360 THEN 'error' WHEN age_minutes > 90 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT event_type, max(ts) AS latest, round(epoch_us(max(ts_end) - max(ts)) / 60000000.0, 6) AS age_minutes
      FROM events, (SELECT max(ts) + INTERVAL 80 MINUTE AS ts_end FROM events) GROUP BY event_type)""")
def freshness_status(spark: SparkSession, folder: str) -> DataFrame:
    """Freshness of each type's feed, eighty minutes after the last event."""
    events = table(spark, folder, "events", "event_type", "ts")
    as_of = events.agg(F.max("ts")).first()[0] + dt.timedelta(minutes=80)
    status = freshness(events, "ts", as_of, by=("event_type",))
    return plain(status.withColumnRenamed("max_loaded_at", "latest"))


@query("""WITH stations AS (SELECT c_custkey, c_acctbal / 100 AS latitude, c_nationkey AS longitude, substr(c_mktsegment, 1, 1) AS pop FROM customer)
SELECT 'latitude' AS breach, c_custkey, round(latitude, 6) AS latitude, longitude, pop FROM stations WHERE NOT latitude BETWEEN 41 AND 52
UNION ALL SELECT 'longitude', c_custkey, round(latitude, 6), longitude, pop FROM stations WHERE NOT longitude BETWEEN -5 AND 10
UNION ALL SELECT 'pop', c_custkey, round(latitude, 6), longitude, pop FROM stations WHERE pop NOT IN ('A', 'R')""")
def dq_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    """Stations that break one of the three rules of plausibility."""
    from priceloom.plans.rules import for_station_plausibility

    stations = table(spark, folder, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 100).alias("latitude"), F.col("c_nationkey").alias("longitude"),
        F.substring("c_mktsegment", 1, 1).alias("pop"))
    found = [failing_rows(stations, rule).withColumn("breach", F.lit(rule.column)) for rule in for_station_plausibility()]
    return plain(found[0].unionByName(found[1]).unionByName(found[2]))
