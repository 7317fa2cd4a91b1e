"""Bronze snapshots to one row per real price change."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from priceloom.contracts import SILVER, WIDE_PRICE, conform, require
from priceloom.fixed_values import SOURCE_TIMEZONE
from priceloom.functions import business_day, date_key, local_to_utc, surrogate_key, utc_wall_clock
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
from priceloom.operators.picking import distinct_members, pick_one
from priceloom.sources.slots import existing_slots, read_bronze, read_slots
from priceloom.storage import Ledger, exists, remove, swap_in

EVENT_KEY = ["station_id", "carburant_id", "maj_timestamp_utc"]

# Silver is stored by the day of the price change: an event's key fixes its partition, so the check
# for known keys opens only the days on which the new events happened.
STORED_SILVER = T.StructType([*SILVER, T.StructField("maj_date", T.DateType())])


def typed_events(bronze: DataFrame, zone: str = SOURCE_TIMEZONE) -> DataFrame:
    """Typed rows with the update time in UTC; rows without a complete event are dropped."""
    priced = bronze.withColumn("prix_euro", F.col("prix_euro").try_cast(WIDE_PRICE))
    rows = require(priced, ["station_id", "carburant_id", "maj_timestamp", "prix_euro"])
    # TIMESTAMP holds an instant; a TIMESTAMP_NTZ column is taken as UTC already.
    seen = F.col("ingestion_ts")
    if bronze.schema["ingestion_ts"].dataType == T.TimestampType():
        seen = utc_wall_clock(seen)
    typed = (
        rows.withColumn("maj_timestamp_utc", local_to_utc(F.col("maj_timestamp"), zone))
        .withColumn("ingestion_ts", seen)
        .withColumn("prix_sk", F.lit(None).cast("string"))
    )
    return conform(typed, SILVER).drop("prix_sk")


def silver_events(bronze: DataFrame, zone: str = SOURCE_TIMEZONE) -> DataFrame:
    """One row per (station, fuel, update time): the first time it was seen."""
    first = pick_one(typed_events(bronze, zone), EVENT_KEY, [F.col("ingestion_ts").asc()])
    return first.select(surrogate_key(*EVENT_KEY).alias("prix_sk"), *SILVER.fieldNames()[1:])


def keyed_events(silver: DataFrame, zone: str = SOURCE_TIMEZONE) -> DataFrame:
    """Events with the four foreign keys; the day is the local business day."""
    local_day = business_day(F.col("maj_timestamp_utc"), zone)
    return silver.select(
        "prix_sk",
        surrogate_key("station_id").alias("station_sk"),
        surrogate_key("carburant_id").alias("carburant_sk"),
        surrogate_key("cp", "ville").alias("localisation_sk"),
        date_key(local_day).alias("date_sk"),
        local_day.alias("maj_date_paris"),
        "maj_timestamp_utc",
        "prix_euro",
        "ingestion_ts",
        "source_url",
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, STORED_SILVER)


_SORT = ("station_id",)


def merge_silver(
    path: str,
    bronze: DataFrame,
    zone: str = SOURCE_TIMEZONE,
    known: DataFrame | None = None,
    feed: str | None = None,
) -> MergeResult:
    """Add bronze rows to stored silver; of several sightings of an event the earliest stays.

    ``known`` are bronze rows of an older slot that is in silver already. A snapshot repeats almost all
    of its predecessor, so comparing the two leaves the few changed prices, and only the days on which
    those were set are looked up in silver.
    """
    events = silver_events(bronze, zone)
    if known is not None:
        events = events.join(distinct_members(typed_events(known, zone), EVENT_KEY), EVENT_KEY, "left_anti")
        events = events.select(*SILVER.fieldNames())
    events = events.withColumn("maj_date", F.to_date("maj_timestamp_utc"))
    return merge_by_key(
        path, events, "prix_sk", "maj_date",
        keep_smallest="ingestion_ts", key_fixes_partition=True, sort_by=_SORT, feed=feed,
    )


class FoldLedger:
    """Which slots stored silver holds, on which days each fold changed something, and the feeds of its changes.

    A fold is noted before it begins and when it is done. One that is noted as begun only was interrupted: if
    its feed is complete the table may hold some of it, else nothing.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path, self._held = spark, path, None
        self._ledger = Ledger(
            spark, path, "dt string, hh string, days array<string>, generation string, fold bigint, begun boolean"
        )

    def _entries(self) -> list:
        return self._ledger.read().collect() if self._held is None else self._held

    def compact(self) -> None:
        """For the one that folds: keep reading the ledger cheap."""
        self._ledger.compact()

    def hold(self) -> FoldLedger:
        """Read the ledger once and answer from that until something is noted here."""
        self._held = self._ledger.read().collect()
        return self

    def _note(self, rows, mode: str = "append") -> None:
        self._held = None
        self._ledger.add(rows, mode)

    def slots(self) -> set[tuple[str, str]]:
        if not exists(self._spark, self._path):
            return set()
        return {(r["dt"], r["hh"]) for r in self._entries() if not r["begun"] and r["dt"]}

    def begin(self, slots: list[tuple[str, str]]) -> int:
        """Note that these slots are about to be folded; returns the fold's number."""
        entries = self._entries()
        number = 1 + max((r["fold"] or 0 for r in entries), default=0)
        generation = entries[0]["generation"] if entries else uuid.uuid4().hex
        self._note((d, h, None, generation, number, True) for d, h in slots or [(None, None)])
        return number

    def add(self, slots: list[tuple[str, str]], result: MergeResult, number: int | None = None) -> None:
        if result.partitions is None:  # the table did not exist before
            self.restart(slots, number)
            return
        days, generation = [str(d) for d in result.partitions], self.generation()
        self._note((d, h, days, generation, number, False) for d, h in slots or [(None, None)])

    def restart(self, slots: list[tuple[str, str]], number: int | None = None) -> None:
        generation = uuid.uuid4().hex
        self._note(((d, h, None, generation, number, False) for d, h in slots), "overwrite")

    def generation(self) -> str:
        """Changes whenever silver is built anew."""
        entries = self._entries()
        return entries[0]["generation"] if entries else uuid.uuid4().hex

    def interrupted(self) -> list[tuple[int, list[tuple[str, str]]]]:
        """(number, slots) of folds whose end is not noted though their feed is complete."""
        entries = self._entries()
        done = {r["fold"] for r in entries if not r["begun"]}
        begun: dict[int, list[tuple[str, str]]] = {}
        for r in entries:
            if r["begun"] and r["fold"] not in done:
                begun.setdefault(r["fold"], [])
                begun[r["fold"]] += [(r["dt"], r["hh"])] if r["dt"] else []
        return [(n, slots) for n, slots in sorted(begun.items()) if feed_is_complete(self._spark, self.feed(n))]

    def reached(self) -> tuple[str, int]:
        """Generation and number of the last finished fold."""
        entries = [r for r in self._entries() if not r["begun"]]
        if not entries:
            return "", 0
        return entries[0]["generation"], max(r["fold"] or 0 for r in entries)

    def feed(self, number: int) -> str:
        return f"{self._path.rstrip('/')}.feed/{self.generation()}/fold={number:08d}"

    def changes_after(self, generation: str, number: int) -> DataFrame | None:
        """[prix_sk, old, new]: what happened to silver since a fold; ``None`` when that is not known."""
        entries = [r for r in self._entries() if not r["begun"]]
        if not entries or entries[0]["generation"] != generation or any(r["fold"] is None for r in entries):
            return None
        since = sorted({r["fold"] for r in entries if r["fold"] > number})
        changed = {r["fold"] for r in entries if r["days"] != []}
        feeds = [self.feed(n) for n in since if n in changed]
        if not all(feed_is_complete(self._spark, f) for f in feeds):
            return None
        found = [read_feed(self._spark, f, STORED_SILVER, "prix_sk", "maj_date") for f in feeds]
        return net_changes(found, "prix_sk") if found else no_changes(self._spark, STORED_SILVER, "prix_sk")

    def forget_feeds(self, number: int) -> None:
        """Drop the feeds up to a fold, once everything that follows silver has taken them."""
        for r in {r["fold"] for r in self._entries() if r["fold"] is not None and r["fold"] <= number}:
            remove(self._spark, self.feed(r))

    def days_after(self, watermark: dt.datetime) -> list[str] | None:
        """Days that can hold events first seen above the watermark; ``None`` when any day can."""
        if not self._ledger.exists():
            return None
        last_hour = (watermark.strftime("%Y-%m-%d"), watermark.strftime("%H"))
        recent = [r["days"] for r in self._entries() if not r["begun"] and r["dt"] and (r["dt"], r["hh"]) >= last_hour]
        if any(days is None for days in recent):
            return None
        return sorted({day for days in recent for day in days})


def before_slots(
    spark: SparkSession, bronze_root: str, folded: set[tuple[str, str]], slots: list[tuple[str, str]]
) -> DataFrame | None:
    """Bronze rows of the last folded slot older than all of ``slots``."""
    older = [s for s in folded if s < min(slots)]
    return read_slots(spark, bronze_root, [max(older)]) if older else None


def fold_new_slots(spark: SparkSession, bronze_root: str, path: str, zone: str = SOURCE_TIMEZONE) -> MergeResult:
    """Bring stored silver up to date with bronze, reading only slots not folded before.

    A slot that arrives late is folded like any other, so the stored table always equals
    ``silver_events`` over all of bronze. Every fold leaves a feed of what it changed.
    """
    ledger = FoldLedger(spark, path)
    ledger.compact()
    finish_folds(spark, path, ledger)
    folded = ledger.slots()
    waiting = [s for s in existing_slots(spark, bronze_root) if s not in folded]
    if not waiting:
        return MergeResult(0, 0, ())
    known = before_slots(spark, bronze_root, folded, waiting)
    number = ledger.begin(waiting)
    feed = ledger.feed(number)
    result = merge_silver(path, read_slots(spark, bronze_root, waiting), zone, known, feed)
    ledger.add(waiting, result, number)
    return result


def waiting_slots(spark: SparkSession, bronze_root: str, path: str, ledger: FoldLedger) -> bool:
    """Whether anything is left to fold, an interrupted fold included. Reads the ledger once, into ``ledger``."""
    folded = ledger.hold().slots()
    return bool(ledger.interrupted()) or any(s not in folded for s in existing_slots(spark, bronze_root))


def finish_folds(spark: SparkSession, path: str, ledger: FoldLedger) -> None:
    """Bring folds that a crash interrupted half way through the table to their ends."""
    for number, slots in ledger.interrupted() if exists(spark, path) else []:
        result = apply_feed(spark, path, ledger.feed(number), STORED_SILVER, "prix_sk", "maj_date", _SORT)
        ledger.add(slots, result, number)


def withdraw_events(spark: SparkSession, path: str, keys: DataFrame) -> MergeResult:
    """Remove events by ``prix_sk``, as a fold without slots: whatever follows silver's feed drops them too.

    Bronze keeps its rows, so a full refresh brings them back unless their slots are mended first.
    """
    ledger = FoldLedger(spark, path)
    finish_folds(spark, path, ledger)
    number = ledger.begin([])
    nothing = spark.createDataFrame([], STORED_SILVER)
    result = merge_by_key(path, nothing, "prix_sk", "maj_date", sort_by=_SORT, removed=keys, feed=ledger.feed(number))
    ledger.add([], MergeResult(0, 0, ("",) if result.removed else (), result.removed), number)
    return result


def rebuild_silver(spark: SparkSession, bronze_root: str, path: str, zone: str = SOURCE_TIMEZONE) -> None:
    """Build silver from all of bronze beside the stored table, then put it in its place."""
    slots = existing_slots(spark, bronze_root)
    fresh = path.rstrip("/") + ".fresh"
    if exists(spark, fresh):
        remove(spark, fresh)
    merge_silver(fresh, read_bronze(spark, bronze_root), zone)
    swap_in(spark, fresh, path)
    ledger = FoldLedger(spark, path)
    ledger.restart(slots, 1 + ledger.reached()[1])
