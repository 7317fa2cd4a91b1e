"""Hourly bronze slots ``dt=YYYY-MM-DD/hh=HH``: first write wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from priceloom.contracts import BRONZE, SLOT
from priceloom.functions import slot_columns
from priceloom.operators.merge import write_partitioned
from priceloom.session import settle
from priceloom.sources.archives import (
    drift_gate,
    format_shapes,
    parsed_stations,
    path_slot,
    scan_archives,
    snapshots_of,
)
from priceloom.storage import Ledger, child_folders, exists

_LEDGER = "dt string, hh string, row_count bigint"
_SHAPES = "dt string, hh string, shape string, row_count bigint"


def shapes_path(root: str) -> str:
    return root.rstrip("/") + ".shapes"


def slot_shapes(spark: SparkSession, root: str) -> DataFrame:
    """[dt, hh, shape, row_count]: the shapes of update times each ingested slot had; empty for slots made otherwise."""
    # A slot that was ingested again after a crash is noted twice, alike.
    return Ledger(spark, shapes_path(root), _SHAPES).read().distinct()


def assign_slot(df: DataFrame, run_time: str) -> DataFrame:
    """Add ``dt`` and ``hh`` from a UTC clock reading."""
    return df.select("*", *slot_columns(F.col(run_time)))


def slot_folders(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """``(dt, hh)`` of every slot folder under ``root``: one per hour, whatever the volume."""
    return [
        (day[3:], hour[3:])
        for day in child_folders(spark, root)
        if day.startswith("dt=")
        for hour in child_folders(spark, f"{root.rstrip('/')}/{day}")
        if hour.startswith("hh=")
    ]


def existing_slots(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """Slots already written: the folders in the ledger, or all folders of a root that has none.

    A slot whose folder was deleted counts as not written; one that was finished without a row has none.
    """
    folders, ledger = slot_folders(spark, root), Ledger(spark, root, _LEDGER)
    if not ledger.exists():
        return folders
    finished = slot_sizes(spark, root)
    return sorted({s for s in folders if s in finished} | {s for s, rows in finished.items() if not rows})


def slot_sizes(spark: SparkSession, root: str) -> dict[tuple[str, str], int]:
    """Rows per finished slot, from the ledger."""
    return {(r["dt"], r["hh"]): r["row_count"] for r in Ledger(spark, root, _LEDGER).read().collect()}


def slots_in(df: DataFrame) -> list[tuple[str, str]]:
    """The slots that stored rows belong to; only their two columns are read."""
    return [(r["dt"], r["hh"]) for r in df.select("dt", "hh").distinct().collect()]


def write_new_slots(df: DataFrame, root: str, slots: list[tuple[str, str]] | None = None) -> DataFrame:
    """Append the rows of slots that do not exist yet.

    Returns DataFrame[dt, hh, path, row_count, bytes_written, skipped], one row per slot in ``df``, or
    per slot in ``slots``: those are finished whether they have rows or not, and no others are.
    The slots present number one per hour, so they are listed on the driver; rows never are. A slot
    that a crashed run left half written is not in the ledger and is replaced as a whole. Without ``slots``
    the rows are written once more to be looked through; for rows that are stored, `slots_in` spares that.
    """
    spark = df.sparkSession
    ledger = Ledger(spark, root, _LEDGER)
    ledger.compact()
    done = set(existing_slots(spark, root))
    if slots is None:
        df = settle(df, "rows")  # looked through for its slots, then written
        slots = slots_in(df)
    fresh = sorted(s for s in slots if s not in done)
    written = {}
    if fresh:
        write_partitioned(only_slots(df, fresh), root, ["dt", "hh"])
        written = _written(spark, root, fresh)
        ledger.add((d, h, written.get((d, h), (0, 0))[0]) for d, h in fresh)
    report = [
        (d, h, f"{root.rstrip('/')}/dt={d}/hh={h}", *written.get((d, h), (0, 0)), (d, h) in done) for d, h in sorted(slots)
    ]
    return spark.createDataFrame(
        report, "dt string, hh string, path string, row_count bigint, bytes_written bigint, skipped boolean"
    )


def _written(spark: SparkSession, root: str, slots: list[tuple[str, str]]) -> dict[tuple[str, str], tuple[int, int]]:
    """Rows and bytes of stored slots, from the files' footers and sizes, in one job for all of them."""
    if not _folders(spark, root, slots):
        return {}
    rows = read_slots(spark, root, slots).select("dt", "hh", "_metadata.file_path", "_metadata.file_size")
    files = rows.groupBy("dt", "hh", "file_path").agg(F.count(F.lit(1)).alias("n"), F.first("file_size").alias("size"))
    found = files.groupBy("dt", "hh").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).collect()
    return {(r["dt"], r["hh"]): (r["n"], r["size"]) for r in found}


def _with_slot(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema if f.name not in ("dt", "hh")] + list(SLOT))


def read_bronze(
    spark: SparkSession,
    root: str,
    dt_from: str | None = None,
    dt_to: str | None = None,
    schema: T.StructType = BRONZE,
) -> DataFrame:
    """The bronze table with text partitions.

    Types are given, never inferred: inference would turn ``hh=09`` into 9, and columns a newer
    writer added are left out. ``dt_from`` and ``dt_to`` (inclusive) prune folders.
    """
    if not exists(spark, root):  # no slot had a row so far
        return spark.createDataFrame([], _with_slot(schema))
    rows = spark.read.schema(_with_slot(schema)).option("pathGlobFilter", "*.parquet").parquet(root)
    if dt_from:
        rows = rows.filter(F.col("dt") >= dt_from)
    if dt_to:
        rows = rows.filter(F.col("dt") <= dt_to)
    return rows


def read_slots(
    spark: SparkSession, root: str, slots: list[tuple[str, str]], schema: T.StructType = BRONZE
) -> DataFrame:
    """The named slots of the bronze table, by their folders: no other folder is even listed."""
    there = _folders(spark, root, slots)
    if not there:
        return spark.createDataFrame([], _with_slot(schema))
    reader = spark.read.schema(_with_slot(schema)).option("pathGlobFilter", "*.parquet").option("basePath", root)
    return reader.parquet(*there)


def _folders(spark: SparkSession, root: str, slots: list[tuple[str, str]]) -> list[str]:
    """The folders of slots; one without a row has none."""
    path = lambda d, h: f"{root.rstrip('/')}/dt={d}/hh={h}"
    if len(slots) > 200:  # a call per day instead of one per slot
        there = set(slot_folders(spark, root))
        return [path(d, h) for d, h in slots if (d, h) in there]
    return [path(d, h) for d, h in slots if exists(spark, path(d, h))]


def only_slots(rows: DataFrame, slots: list[tuple[str, str]]) -> DataFrame:
    """Rows of the named slots; a filter on partition columns, so other folders are not opened."""
    return rows.filter(F.concat_ws("/", "dt", "hh").isin([f"{d}/{h}" for d, h in slots]))


def ingest(spark: SparkSession, raw_root: str, bronze_root: str, source_url: Column | None = None) -> dict[str, DataFrame]:
    """Parse the archives of all slots not yet in bronze and write them.

    Returns ``{"slots": report, "files": statistics per file}``, or nothing when no slot waits. The
    archives stay where they are, so a new bronze root replays the whole history. A file that drifted
    holds its slot back, raises once the other slots are written, and again on every run until it is
    replaced. A slot whose archives have no good price is finished with no rows.
    """
    done = set(existing_slots(spark, bronze_root))
    waiting = [s for s in slot_folders(spark, raw_root) if s not in done]
    if not waiting:
        return {}
    archives = scan_archives(spark, *[f"{raw_root.rstrip('/')}/dt={d}/hh={h}" for d, h in waiting])
    stations = parsed_stations(archives)
    rows, files = snapshots_of(stations, source_url)
    by_slot = files.select(*path_slot(F.col("path")), "drift").groupBy("dt", "hh").agg(F.count("drift").alias("drifted"))
    sound = [(r["dt"], r["hh"]) for r in by_slot.filter("drifted = 0").collect()]
    shapes = only_slots(format_shapes(stations), sound).collect() if sound else []  # a few per slot
    seen = Ledger(spark, shapes_path(bronze_root), _SHAPES)
    seen.compact()
    seen.add((r["dt"], r["hh"], r["shape"], r["row_count"]) for r in shapes)
    report = write_new_slots(rows, bronze_root, sound)
    return {"slots": report, "files": drift_gate(files)}
