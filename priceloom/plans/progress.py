"""Small tables that move on with every fold instead of being rebuilt from all of history.

The latest attributes per station and the places seen follow the feed of silver, the latest prices (in
`histogram`) that of the fact: each change names the row before and the row after, so what is gone can be taken back.
A table's note says how far it has come; both take their place together, so no change counts twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from priceloom.operators.picking import pick_one
from priceloom.plans.fact import FactLog
from priceloom.plans.silver import FoldLedger
from priceloom.session import settle
from priceloom.storage import current_path, exists, note_of, replace_table


def advance(
    spark: SparkSession,
    path: str,
    log: FoldLedger | FactLog,
    whole: Callable[[], DataFrame],
    step: Callable[[DataFrame, DataFrame], DataFrame],
    basis: str = "",
) -> DataFrame:
    """Bring the table stored at ``path`` up to date with what ``log`` keeps the feed of.

    ``step`` makes the next version from the stored one and the changes [key, old, new] since; ``whole`` makes
    it from everything, when there is none, when the feed does not reach back that far, or when ``basis``,
    which stands for whatever else the table depends on, is another.
    """
    generation, number = log.reached()
    note = note_of(spark, path) if exists(spark, path) else {}
    now = {"generation": generation, "number": number, "basis": basis}
    if note == now and generation:
        return spark.read.parquet(current_path(spark, path))
    changes = None
    if note and note["basis"] == basis:
        changes = log.changes_after(note["generation"], note["number"])
    if changes is None:
        return replace_table(whole(), path, now)
    return replace_table(step(spark.read.parquet(current_path(spark, path)), changes), path, now)


def next_latest(
    stored: DataFrame, changes: DataFrame, table: DataFrame, keys: list[str], order: list[Column], by: str | None = None
) -> DataFrame:
    """The row per key that comes first in ``order``, after some rows of ``table`` have changed.

    A key whose stored row is gone is looked for again in ``table``; all others only meet their new rows. Where
    nothing stored is gone ``table`` is not read.
    """
    columns = stored.columns
    row = F.struct(*[F.col(c) for c in columns])
    fresh = changes.filter("new IS NOT NULL").select(*[F.col(f"new.{c}") for c in columns])
    gone = changes.filter("old IS NOT NULL").select(*[F.col(f"old.{c}") for c in columns]).distinct()
    if by:  # a changed row may take the place of the one before: then nothing is missing
        again = changes.filter("new IS NOT NULL").select(*[F.col(f"new.{c}").alias(c) for c in [*keys, by]])
        gone = gone.join(again, [*keys, by], "left_anti").select(*columns)
        replaced = changes.filter("old IS NOT NULL AND new IS NOT NULL").select(*[F.col(f"old.{c}") for c in columns])
    held = stored.select(*keys, row.alias("_row"))
    lost = held.join(gone.select(*keys, row.alias("_gone")), keys).filter(F.col("_row").eqNullSafe(F.col("_gone")))
    lost = settle(lost.select(*keys).distinct(), "lost")
    kept = stored
    if by:
        out = replaced.select(*keys, row.alias("_gone"))
        stale = held.join(out, keys).filter(F.col("_row").eqNullSafe(F.col("_gone"))).select(*keys)
        kept = stored.join(stale, keys, "left_anti").select(*columns)
    found = pick_one(kept.unionByName(fresh), keys, order)
    if lost.isEmpty():
        return found
    again = pick_one(table.select(*columns).join(lost, keys, "left_semi"), keys, order)
    return found.join(lost, keys, "left_anti").select(*columns).unionByName(again.select(*columns))


_ATTRIBUTES = ["station_id", "cp", "ville", "adresse", "pop", "latitude", "longitude", "ingestion_ts"]


def latest_attributes(spark: SparkSession, path: str, silver: DataFrame, folds: FoldLedger) -> DataFrame:
    """Per station the attributes it was last seen with, and when."""
    keys, order = ["station_id"], [F.col("ingestion_ts").desc()]
    return advance(
        spark, path, folds, lambda: pick_one(silver.select(*_ATTRIBUTES), keys, order),
        lambda stored, changes: next_latest(stored, changes, silver, keys, order),
    )


def count_changes(stored: DataFrame, changes: DataFrame, columns: list[str], count: str = "row_count") -> DataFrame:
    """Counts per combination of ``columns`` after rows have come (+1) and gone (-1); zeros are left out.

    A count below zero would mean that a row went which never came: that stops the job.
    """
    side = lambda name, by: changes.filter(F.col(name).isNotNull()).select(
        *[F.col(f"{name}.{c}").alias(c) for c in columns], F.lit(by).cast("bigint").alias(count)
    )
    moved = stored.select(*columns, count).unionByName(side("old", -1)).unionByName(side("new", 1))
    summed = moved.groupBy(*columns).agg(F.sum(count).alias(count)).filter(F.col(count) != 0)
    below = F.raise_error(F.lit(f"{count} below zero")).cast("bigint")
    return summed.withColumn(count, F.when(F.col(count) > 0, F.col(count)).otherwise(below))


def seen_places(spark: SparkSession, path: str, silver: DataFrame, folds: FoldLedger) -> DataFrame:
    """The distinct (cp, ville) of silver, kept as counts of the events that name them."""
    columns = ["cp", "ville"]
    counts = advance(
        spark, path, folds, lambda: silver.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")),
        lambda stored, changes: count_changes(stored, changes, columns),
    )
    return counts.select(*columns)


PRICES = ["station_sk", "carburant_sk", "localisation_sk", "prix_euro", "maj_timestamp_utc"]
PAIR = ["station_sk", "carburant_sk"]

