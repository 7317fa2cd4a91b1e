"""The feed: archives made from orders, parsed back; slots; profiles."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from driver_queries.registry import plain, query, spread, table
from driver_queries.silver import OBSERVED, observed
from priceloom.functions import slot_columns, utc_instant
from priceloom.session import fresh_path, settle
from priceloom.sources.archives import FeedDriftError, parse_stats, price_rows, slot_instant, type_stations, unpack
from priceloom.sources.profile import accented_samples, audit, field_presence, id_name_pairs, in_id_order, text_shapes
from priceloom.sources.reference import read_reference_csv
from priceloom.sources.slots import assign_slot, ingest, read_bronze, write_new_slots
from priceloom.fixed_values import ACCENTED_LETTERS

_HEAD = '<?xml version="1.0" encoding="ISO-8859-1"?>'


def _zip(documents: DataFrame) -> DataFrame:
    """DataFrame[path, xml] to archives[path, content] in the feed's encoding."""

    def pack(xml: str) -> bytes:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("feed.xml", xml.encode("latin-1"))
        return buffer.getvalue()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = pa.array([pack(x.as_py()) for x in batch.column("xml")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("path"), content], ["path", "content"])

    return documents.select("path", "xml").mapInArrow(run, "path string, content binary")


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """One archive per order: a station with a good price, a damaged one and an outage.

    One station in fifty has no id; the damage is by turns in time, value, fuel id and fuel name.
    """
    orders = spread(
        table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    )
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 5
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    value = F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    station_id = F.when(key % 50 == 0, "").otherwise(F.format_string('id="%d"', key))
    damaged = F.format_string(
        '<prix id="%s" nom="%s" maj="%s" valeur="%s"/>',
        F.when(kind == 2, "").otherwise("9"),
        F.when(kind == 3, "").otherwise("other"),
        F.when(kind == 0, "soon").otherwise(day),
        F.when(kind == 1, "1,5").otherwise(value),
    )
    xml = F.concat(
        F.lit(_HEAD + "<pdv_liste><pdv "), station_id,
        F.format_string(' latitude="%d" longitude="%s" cp="%s" pop="R">', F.col("o_custkey") * 100, F.when(key % 3 == 0, "").otherwise("-432100"),
                        F.when(key % 4 == 0, "").otherwise(F.lpad(F.col("o_custkey").cast("string"), 5, "0"))),
        F.format_string("<ville> Pré-Neuf %d\n</ville><adresse/>", F.col("o_custkey")),
        F.format_string('<prix id="%s" nom="%s" maj="%s" valeur="%s"/>', F.substring("o_orderpriority", 1, 1), F.col("o_orderpriority"), day, value),
        damaged,
        F.lit('<rupture id="1" nom="Gazole"/></pdv></pdv_liste>'),
    )
    return _zip(orders.select(F.format_string("/raw/dt=2026-06-03/hh=%02d/%d.zip", key % 24, key).alias("path"), xml.alias("xml")))


_DAMAGE = "o_orderkey % 5 < 4"


@query(f"""WITH prices AS (
  SELECT *, substr(o_orderpriority, 1, 1) AS carburant_id, o_orderpriority AS carburant_nom FROM orders
  UNION ALL SELECT *, '9', 'other' FROM orders WHERE NOT ({_DAMAGE}))
SELECT CAST(o_orderkey AS VARCHAR) AS station_id,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE lpad(CAST(o_custkey AS VARCHAR), 5, '0') END AS cp,
  'Pré-Neuf ' || CAST(o_custkey AS VARCHAR) AS ville, CAST(NULL AS VARCHAR) AS adresse, 'R' AS pop,
  round(o_custkey / CAST(1000 AS DOUBLE), 6) AS latitude, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE -4.321 END AS longitude,
  carburant_id, carburant_nom, o_orderdate AS maj_timestamp, round(round(o_totalprice, 2), 6) AS prix_euro
FROM prices WHERE o_orderkey % 50 <> 0""")
def xml_flatten_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    # Written once: which files were refused is known only when all have been read.
    stations = type_stations(settle(unpack(archives(spark, folder)), "stations"))
    rows = price_rows(stations, slot_instant(F.lit("2026-06-03"), F.lit("10")), F.col("path"))
    return plain(rows.drop("ingestion_ts", "source_url"))


@query(f"""SELECT o_orderkey % 24 AS hour, count(*) AS stations,
  sum(CASE WHEN o_orderkey % 50 = 0 THEN 0 WHEN {_DAMAGE} THEN 1 ELSE 2 END)::BIGINT AS price_rows,
  sum(CASE WHEN o_orderkey % 50 = 0 OR {_DAMAGE} THEN 1 ELSE 0 END)::BIGINT AS errors FROM orders GROUP BY 1""")
def xml_parse_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = parse_stats(type_stations(unpack(archives(spark, folder))))
    hour = F.regexp_extract("path", r"/hh=(\d+)/", 1).cast("bigint").alias("hour")
    return stats.groupBy(hour).agg(
        F.sum("station_count").alias("stations"),
        F.sum("price_row_count").alias("price_rows"),
        F.sum("parse_errors").alias("errors"),
    )


def _land(documents: DataFrame, root: str) -> None:
    """Write each archive of DataFrame[path, xml] under ``root``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                system, target = fs.FileSystem.from_uri(f"{root}/{path}" if "://" in root else f"file://{root.removeprefix('file:')}/{path}")
                system.create_dir(target.rsplit("/", 1)[0])
                with system.open_output_stream(target) as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([batch.column("path")], ["path"])

    _zip(documents).mapInArrow(run, "path string").count()


#: Keys in a row that share an archive's number: an archive has a station for one key in 84 of them.
_NUMBERED = 84_000


def many_stations(orders: DataFrame) -> DataFrame:
    """DataFrame[path, xml]: archives of up to a thousand stations, the more the more orders; some are truncated."""
    key = F.col("o_orderkey")
    station = F.concat(
        F.format_string('<pdv id="%d" cp="34150" pop="R" latitude="4365000" longitude="355000"><ville>Pré-Neuf</ville>', key),
        F.format_string('<prix id="%s" nom="%s" maj="%s" valeur="%s"/></pdv>', F.substring("o_orderpriority", 1, 1), F.col("o_orderpriority"),
                        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.col("o_totalprice").cast("decimal(14,2)").cast("string")),
    )
    day, hour, part, number = key % 28, key % 4, key % 3, F.floor(key / _NUMBERED)
    files = orders.groupBy(day.alias("day"), hour.alias("hour"), part.alias("part"), number.alias("number")).agg(
        F.array_join(F.collect_list(station), "").alias("stations")
    )
    broken = (F.col("day") % 9 == 4) & (F.col("part") == 0)
    end = F.when(broken, F.lit("<pdv id=")).otherwise(F.lit("</pdv_liste>"))
    path = F.format_string("dt=2026-05-%02d/hh=%02d/%d-%d.zip", F.col("day") + 1, "hour", "part", "number")
    return files.select(path.alias("path"), F.concat(F.lit(_HEAD + "<pdv_liste>"), "stations", end).alias("xml"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS station_id, substr(o_orderpriority, 1, 1) AS carburant_id, round(round(o_totalprice, 2), 6) AS prix_euro,
  '2026-05-' || lpad(CAST(1 + o_orderkey % 28 AS VARCHAR), 2, '0') AS dt, lpad(CAST(o_orderkey % 4 AS VARCHAR), 2, '0') AS hh
FROM orders WHERE o_orderkey % 28 % 9 <> 4""")
def landed_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Archives of many stations, landed and ingested: a slot with a truncated one among them is held back whole."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    root = fresh_path(spark, "landed")
    _land(many_stations(orders), root)
    bronze = fresh_path(spark, "bronze")
    try:
        ingest(spark, root, bronze)
    except FeedDriftError:
        pass  # said loudly, as it should be; what the other slots hold is what this query is about
    return plain(read_bronze(spark, bronze).select("station_id", "carburant_id", "prix_euro", "dt", "hh"))


_DRIFTS = ["root element is", "no <pdv>", "not well-formed"]


@query(f"""SELECT CASE o_orderkey % 7 WHEN 0 THEN '{_DRIFTS[0]}' WHEN 1 THEN '{_DRIFTS[1]}' WHEN 2 THEN '{_DRIFTS[2]}' ELSE 'none' END AS drift,
  count(*) AS files FROM orders GROUP BY 1""")
def xml_drift_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Files per kind of drift, three orders in seven being given a broken document."""
    key = F.col("o_orderkey")
    body = F.format_string('<pdv id="%d"/>', key)
    xml = (
        F.when(key % 7 == 0, F.concat(F.lit(_HEAD + "<wrong_root>"), body, F.lit("</wrong_root>")))
        .when(key % 7 == 1, _HEAD + "<pdv_liste></pdv_liste>")
        .when(key % 7 == 2, F.concat(F.lit(_HEAD + "<pdv_liste>"), body))
        .otherwise(F.concat(F.lit(_HEAD + "<pdv_liste>"), body, F.lit("</pdv_liste>")))
    )
    orders = spread(table(spark, folder, "orders", "o_orderkey"))
    documents = orders.select(F.format_string("%d.zip", key).alias("path"), xml.alias("xml"))
    stats = parse_stats(type_stations(unpack(_zip(documents))))
    kind = F.coalesce(F.regexp_extract("drift", "^(" + "|".join(_DRIFTS) + ")", 1), F.lit("none"))
    return stats.groupBy(kind.alias("drift")).agg(F.count(F.lit(1)).alias("files"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hh FROM events")
def slot_assign(spark: SparkSession, folder: str) -> DataFrame:
    return assign_slot(table(spark, folder, "events", "event_id", "ts"), "ts").drop("ts")


def slotted(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze rows with their daily slots, written once."""
    rows = observed(spark, folder).select("*", *slot_columns(F.col("ingestion_ts")))
    return settle(rows.withColumn("ingestion_ts", utc_instant(F.col("ingestion_ts"))), "observed")


_BRONZE_SQL = """station_id, cp, ville, adresse, pop, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
  carburant_id, carburant_nom, maj_timestamp, round(prix_euro, 6) AS prix_euro, source_url,
  strftime(ingestion_ts, '%Y-%m-%d') AS dt, strftime(ingestion_ts, '%H') AS hh"""


@query(f"WITH {OBSERVED} SELECT {_BRONZE_SQL} FROM observed")
def bronze_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    root = fresh_path(spark, "bronze")
    write_new_slots(slotted(spark, folder), root)
    return plain(read_bronze(spark, root).drop("ingestion_ts"))


@query(f"WITH {OBSERVED} SELECT {_BRONZE_SQL} FROM observed")
def bronze_tolerant_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Files with a column nobody asked for."""
    root = fresh_path(spark, "bronze")
    write_new_slots(slotted(spark, folder).withColumn("new_column", F.lit(1)), root)
    return plain(read_bronze(spark, root).drop("ingestion_ts"))


@query(f"""WITH {OBSERVED} SELECT {_BRONZE_SQL} FROM observed
WHERE CAST(ingestion_ts AS DATE) >= (SELECT CAST(min(ingestion_ts) AS DATE) + 7 FROM observed)""")
def bronze_pruned_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze from its second week on: older folders are not opened."""
    import datetime as dt

    root = fresh_path(spark, "bronze")
    write_new_slots(slotted(spark, folder), root)
    first = read_bronze(spark, root).agg(F.min("dt")).first()[0]
    start = dt.date.fromisoformat(first) + dt.timedelta(days=7)
    return plain(read_bronze(spark, root, dt_from=start.isoformat()).drop("ingestion_ts"))


@query(f"""WITH {OBSERVED}, slots AS (
  SELECT strftime(ingestion_ts, '%Y-%m-%d') AS dt, strftime(ingestion_ts, '%H') AS hh, count(*) AS n FROM observed GROUP BY ALL),
halves AS (SELECT *, (SELECT min(dt) FROM slots) < dt AS later FROM slots)
SELECT 'first' AS run, dt, hh, n AS row_count, false AS skipped FROM halves WHERE NOT later
UNION ALL SELECT 'second', dt, hh, CASE WHEN later THEN n ELSE 0 END, NOT later FROM halves
UNION ALL SELECT 'third', dt, hh, 0, true FROM halves""")
def slot_write_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """The first slot alone, then all, then all again: what exists is skipped."""
    root, rows = fresh_path(spark, "bronze"), slotted(spark, folder)
    first = rows.agg(F.min("dt")).first()[0]
    runs = [("first", rows.filter(F.col("dt") == first)), ("second", rows), ("third", rows)]
    reports = [write_new_slots(part, root).withColumn("run", F.lit(name)) for name, part in runs]
    return reports[0].unionByName(reports[1]).unionByName(reports[2]).select("run", "dt", "hh", "row_count", "skipped")


@query("""SELECT o_orderstatus AS id, o_orderpriority AS nom, count(*) AS row_count FROM orders GROUP BY ALL""")
def source_pairs(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.col("o_orderstatus").alias("id"), F.col("o_orderpriority").alias("nom"))
    return in_id_order(id_name_pairs(orders, "id", "nom"), "id")


@query(f"""SELECT 'text' AS "column", count(*) AS row_count, count(*) FILTER (text IS NULL OR trim(text, ' ') = '') AS missing,
  count(*) FILTER (regexp_matches(text, '[{ACCENTED_LETTERS}]')) AS accented FROM documents
UNION ALL SELECT 'source', count(*), count(*) FILTER (source IS NULL OR trim(source, ' ') = ''),
  count(*) FILTER (regexp_matches(source, '[{ACCENTED_LETTERS}]')) FROM documents""")
def source_field_presence(spark: SparkSession, folder: str) -> DataFrame:
    return field_presence(table(spark, folder, "documents", "text", "source"), ["text", "source"])


@query(f"""SELECT text FROM documents WHERE regexp_matches(text, '[{ACCENTED_LETTERS}]') ORDER BY text LIMIT 5""")
def source_accented_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Five accented texts, in text order (a sample report, so the limit belongs to it)."""
    return accented_samples(table(spark, folder, "documents", "text"), "text", 5)


@query("""SELECT regexp_replace(CAST(ts AS VARCHAR), '[0-9]', '9', 'g') AS shape, count(*) AS row_count FROM events GROUP BY 1""")
def timestamp_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Formats of the update time, as text."""
    return text_shapes(table(spark, folder, "events", "ts"), "ts")


@query(f"""WITH {OBSERVED} SELECT count(*) AS row_count, min(prix_euro) AS prix_euro_min, max(prix_euro) AS prix_euro_max,
  round(min(latitude), 6) AS latitude_min, round(max(latitude), 6) AS latitude_max,
  count(DISTINCT station_id) AS distinct_station_id, count(DISTINCT carburant_id) AS distinct_carburant_id FROM observed""")
def bronze_audit(spark: SparkSession, folder: str) -> DataFrame:
    return plain(audit(observed(spark, folder), ["prix_euro", "latitude"], ["station_id", "carburant_id"]))


@query("""SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer""")
def reference_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as CSV and read back as text: leading zeros survive."""
    path = fresh_path(spark, "csv")
    customers = table(spark, folder, "customer")
    customers.select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("code"), F.col("c_name").alias("name"),
                     F.col("c_nationkey").alias("nation")).write.option("header", True).csv(path)
    return read_reference_csv(spark, path, ["code", "name", "nation"])
