"""The price fact: incremental, keyed, strictly above the watermark."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from priceloom.contracts import FCT_PRIX_CARBURANT, PRICE, conform, guard_not_null, require_contract
from priceloom.fixed_values import FIRST_WATERMARK, SOURCE_TIMEZONE
from priceloom.operators.merge import (
    MergeResult,
    apply_feed,
    feed_is_complete,
    merge_by_key,
    net_changes,
    no_changes,
    read_feed,
    read_table,
)
from priceloom.operators.watermark import after, high_watermark
from priceloom.plans.silver import STORED_SILVER, FoldLedger, keyed_events, read_silver
from priceloom.storage import Ledger, exists, read_text, remove, swap_in, write_text

# ``number`` counts the updates of a ``generation`` of the fact, ``fold`` is the last fold of silver it has taken.
# ``dropped`` says that late events were left out, so silver's rows before a change are not always the fact's.
_COMMITS = (
    "watermark string, inserted bigint, updated bigint, number bigint, generation string, "
    "silver string, fold bigint, dropped boolean"
)
_SORT = ("station_sk",)


def fact_rows(keyed: DataFrame) -> DataFrame:
    """Keyed events in the fact's contract. Prices too large for it stay in silver, whose checks count them."""
    keyed = keyed.filter(F.col("prix_euro").try_cast(PRICE).isNotNull())
    return conform(keyed.withColumn("ingestion_date", F.to_date("ingestion_ts")), FCT_PRIX_CARBURANT)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, FCT_PRIX_CARBURANT)


def committed_watermark(spark: SparkSession, path: str) -> dt.datetime:
    """Watermark of the last finished update.

    Taken from the ledger: rows of an update that crashed half way must not move it.
    """
    if not exists(spark, path):
        return dt.datetime.fromisoformat(FIRST_WATERMARK)
    ledger = Ledger(spark, path, _COMMITS)
    entries = ledger.read().select("watermark").collect()
    if not entries:
        return high_watermark(read_fact(spark, path), "ingestion_ts")
    return dt.datetime.fromisoformat(max((r["watermark"] for r in entries if r["watermark"]), default=FIRST_WATERMARK))


class FactLog:
    """What is noted of the fact's updates, and the feeds of their changes."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path
        self._ledger = Ledger(spark, path, _COMMITS)
        # What is noted of a table that was deleted holds no longer.
        self.entries = self._ledger.read().collect() if exists(spark, path) else []
        self.last = max(self.entries, key=lambda r: r["number"] or 0, default=None)

    def watermark(self) -> dt.datetime:
        marks = [r["watermark"] for r in self.entries if r["watermark"]]
        return dt.datetime.fromisoformat(max(marks, default=FIRST_WATERMARK))

    def reached(self) -> tuple[str, int]:
        """Generation and number of the last update."""
        return (self.last["generation"] or "", self.last["number"] or 0) if self.last else ("", 0)

    def feed(self, number: int) -> str:
        return f"{self._path.rstrip('/')}.feed/{self.reached()[0]}/update={number:08d}"

    def begin(self, watermark: dt.datetime, silver: str, fold: int, dropped: bool) -> str:
        """Note what the next update will have taken; returns the folder of its feed."""
        feed = self.feed(self.reached()[1] + 1)
        begun = {"watermark": watermark.isoformat(sep=" "), "silver": silver, "fold": fold, "dropped": dropped}
        write_text(self._spark, feed + ".begun", json.dumps(begun))
        return feed

    def interrupted(self) -> dict | None:
        """What an update with a complete feed had begun, if its end is not noted."""
        if not self.last or not feed_is_complete(self._spark, self.feed(self.reached()[1] + 1)):
            return None
        return json.loads(read_text(self._spark, self.feed(self.reached()[1] + 1) + ".begun"))

    def note(self, watermark: dt.datetime, result: MergeResult, silver: str | None, fold: int | None, dropped: bool) -> None:
        """The update after the last one is done; one that built the table anew starts another generation."""
        generation, number = self.reached()
        anew = result.partitions is None or not generation
        row = (
            watermark.isoformat(sep=" "), result.inserted, result.updated + result.removed, number + 1,
            uuid.uuid4().hex if anew else generation, silver, fold, dropped,
        )
        if result.partitions is None:
            self._ledger.restart([row])
        else:
            self._ledger.add([row])

    def changes_after(self, generation: str, number: int) -> DataFrame | None:
        """[prix_sk, old, new]: what happened to the fact since an update; ``None`` when that is not known."""
        if not self.last or not generation or self.last["generation"] != generation:
            return None
        since = [r for r in self.entries if (r["number"] or 0) > number]
        if any(r["generation"] != generation for r in since):
            return None
        feeds = [self.feed(r["number"]) for r in sorted(since, key=lambda r: r["number"]) if r["inserted"] or r["updated"]]
        if not all(feed_is_complete(self._spark, f) for f in feeds):
            return None
        found = [read_feed(self._spark, f, FCT_PRIX_CARBURANT, "prix_sk", "ingestion_date") for f in feeds]
        return net_changes(found, "prix_sk") if found else no_changes(self._spark, FCT_PRIX_CARBURANT, "prix_sk")

    def forget_feeds(self, number: int) -> None:
        """Drop the feeds up to an update, once everything that follows the fact has taken them."""
        for r in self.entries:
            if r["number"] is not None and r["number"] <= number:
                remove(self._spark, self.feed(r["number"]))


def update_fact(
    spark: SparkSession,
    silver: DataFrame,
    path: str,
    zone: str = SOURCE_TIMEZONE,
    days: list[str] | None = None,
) -> MergeResult:
    """Merge events first seen strictly after the fact's watermark; build it all when it is missing.

    ``days`` names the days of silver that can hold such events, if known. Silver holds each key once,
    so a fresh key can only match rows that a crashed update of the same events left behind. Those lie
    on or after the watermark's day, and no older partition of the fact is opened.
    """
    if days == []:
        return MergeResult(0, 0, ())
    watermark = committed_watermark(spark, path)
    if days is not None:
        silver = silver.filter(F.col("maj_date").cast("string").isin(days))
    recent = F.col("ingestion_date") >= F.lit(watermark.date())
    rows = _checked_rows(after(silver, "ingestion_ts", watermark), zone)
    result = merge_by_key(path, rows, "prix_sk", "ingestion_date", target_filter=recent, sort_by=_SORT)
    reached = max(watermark, high_watermark(read_fact(spark, path).filter(recent), "ingestion_ts"))
    # No feed was left, and late events may be missing: who follows the fact starts over.
    FactLog(spark, path).note(reached, result, None, None, result.partitions is not None)
    return result


def follow_silver(
    spark: SparkSession, silver_path: str, path: str, zone: str = SOURCE_TIMEZONE, late: str = "drop"
) -> MergeResult:
    """Bring the fact up to date with silver's feed, without looking at silver itself.

    Events first seen strictly after the fact's watermark are inserted, withdrawn ones removed. What was
    first seen at or before the watermark is late: dropped, or let in with ``late="merge"``. The feed's old
    rows say where an event lies in the fact, so only those ingestion dates are opened; when late events were
    dropped before, they may lie elsewhere and all keys are searched. Leaves a feed of its own. Where
    silver's feed does not reach back to the fact's last update, events are found by the watermark instead.
    """
    folds = FoldLedger(spark, silver_path).hold()
    log = finish_update(spark, path)
    generation, fold = folds.reached()
    if not log.last or log.last["silver"] != generation or log.last["fold"] is None:
        return _catch_up(spark, silver_path, path, zone, folds, log, late)
    if log.last["fold"] == fold:
        return MergeResult(0, 0, ())
    changes = folds.changes_after(generation, log.last["fold"])
    if changes is None:
        return _catch_up(spark, silver_path, path, zone, folds, log, late)

    watermark = log.watermark()
    mark = F.lit(watermark.isoformat(sep=" ")).cast("timestamp_ntz")
    day = lambda row: F.to_date(F.col(row)["ingestion_ts"])
    is_late = F.col("new.ingestion_ts") <= mark
    changes = changes.withColumn("is_late", F.coalesce(is_late, F.lit(False)))
    seen = changes.groupBy("is_late", F.col("new").isNull().alias("gone"), day("old").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max("new.ingestion_ts").alias("newest")
    ).collect()
    dropped = late == "drop" and any(r["is_late"] for r in seen)
    taken = changes if late == "merge" else changes.filter(~F.col("is_late"))
    fits = F.col("new.prix_euro").try_cast(PRICE).isNotNull()
    rows = _checked_rows(taken.filter(F.col("new").isNotNull() & fits).select("new.*"), zone)
    removed = taken.filter(F.col("old").isNotNull() & ~(F.col("new").isNotNull() & fits)).select("prix_sk")
    # A fresh event is nowhere yet, a late or withdrawn one where its old row says.
    where = None
    if not log.last["dropped"]:
        days = sorted({r["day"] for r in seen if r["day"] is not None})
        where = F.col("ingestion_date").isin(days) if days else F.lit(False)
    newest = [r["newest"] for r in seen if r["newest"] is not None and not r["is_late"]]
    reached, dropped = max([watermark, *newest]), dropped or bool(log.last["dropped"])
    feed = log.begin(reached, generation, fold, dropped)
    result = merge_by_key(
        path, rows, "prix_sk", "ingestion_date", keep_smallest="ingestion_ts", target_filter=where, sort_by=_SORT,
        removed=removed, feed=feed,
    )
    log.note(reached, result, generation, fold, dropped)
    return result


def _catch_up(
    spark: SparkSession, silver_path: str, path: str, zone: str, folds: FoldLedger, log: FactLog, late: str
) -> MergeResult:
    """Find events by the watermark, then note how far silver was taken. ``late="merge"`` looks at all of silver."""
    silver, watermark = read_silver(spark, silver_path), log.watermark()
    generation, fold = folds.reached()
    known = bool(log.entries)
    if late == "drop" or not known:
        days = folds.days_after(watermark) if known else None
        if days is not None:
            silver = silver.filter(F.col("maj_date").cast("string").isin(days))
        silver = after(silver, "ingestion_ts", watermark)
    where = F.col("ingestion_date") >= F.lit(watermark.date()) if late == "drop" else None
    result = merge_by_key(
        path, _checked_rows(silver, zone), "prix_sk", "ingestion_date", keep_smallest="ingestion_ts",
        target_filter=where, sort_by=_SORT, feed=log.begin(watermark, generation, fold, late == "drop") if known else None,
    )
    recent = read_fact(spark, path).filter(F.col("ingestion_date") >= F.lit(watermark.date()))
    reached = max(watermark, high_watermark(recent, "ingestion_ts"))
    log.note(reached, result, generation, fold, result.partitions is not None and late == "drop")
    return result


def finish_update(spark: SparkSession, path: str) -> FactLog:
    """Bring an update that a crash interrupted half way through the table to its end, and note it."""
    Ledger(spark, path, _COMMITS).compact()
    log = FactLog(spark, path)
    begun = log.interrupted()
    if begun is None:
        return log
    result = apply_feed(spark, path, log.feed(log.reached()[1] + 1), FCT_PRIX_CARBURANT, "prix_sk", "ingestion_date", _SORT)
    watermark = dt.datetime.fromisoformat(begun["watermark"])
    recent = read_fact(spark, path).filter(F.col("ingestion_date") >= F.lit(watermark.date()))
    reached = max(watermark, high_watermark(recent, "ingestion_ts"))
    log.note(reached, result, begun["silver"], begun["fold"], begun["dropped"])
    return FactLog(spark, path)


def rebuild_fact(
    spark: SparkSession,
    silver: DataFrame,
    path: str,
    zone: str = SOURCE_TIMEZONE,
    upto: tuple[str, int] | None = None,
) -> MergeResult:
    """Build the fact from all of silver beside the stored table, then put it in its place.

    ``upto`` is how far silver's folds reach, if it is stored: the next update follows its feed from there.
    """
    fresh = path.rstrip("/") + ".fresh"
    if exists(spark, fresh):
        remove(spark, fresh)
    result = merge_by_key(fresh, _checked_rows(silver, zone), "prix_sk", "ingestion_date", sort_by=_SORT)
    swap_in(spark, fresh, path)
    reached = high_watermark(read_fact(spark, path), "ingestion_ts")
    FactLog(spark, path).note(reached, MergeResult(result.inserted, 0), *(upto or (None, None)), False)
    return result


def _checked_rows(silver: DataFrame, zone: str) -> DataFrame:
    rows = require_contract(fact_rows(keyed_events(silver, zone)), FCT_PRIX_CARBURANT)
    return guard_not_null(rows, FCT_PRIX_CARBURANT)
