"""Keyed merge into a partitioned Parquet table, with a feed of what it changes."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from priceloom.contracts import ContractError, contract_problems
from priceloom.session import fresh_path, settle
from priceloom.storage import current_path, exists, recover, remove, staging, swap_in, switch_partitions


@dataclass(frozen=True)
class MergeResult:
    """Row counts, and the partitions in which rows of the source now lie (``None``: any)."""

    inserted: int
    updated: int
    partitions: tuple | None = None
    removed: int = 0


#: A partition with more rows is laid out as files that hold disjoint ranges of its first sort column.
ROWS_PER_FILE = 4_000_000
#: Feeds and a merge's own tables consist of hashed keys for the most part.
DENSE = "zstd"


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    mode: str = "overwrite",
    sort_by: tuple[str, ...] = (),
    counts: Mapping | None = None,
    rows_per_file: int | None = None,
) -> None:
    """Write by partition with files of even size.

    The rebalance hint lets AQE split a partition that holds most of the rows and join tiny ones, so
    one busy day neither becomes one task nor thousands of small files. Where ``counts``, the rows per
    partition as far as they are known, tell of a partition of several files, rows are dealt out by range
    instead: each of its files then holds a range of ``sort_by`` of its own, and a reader who looks for one
    value skips the others by their footers. ``overwrite`` replaces only the partitions that occur in ``df``.
    """
    rows_per_file = rows_per_file or ROWS_PER_FILE
    dealt = df.hint("rebalance", *partition_by)
    if sort_by and counts and max(counts.values()) > rows_per_file:
        files = sum(-(-n // rows_per_file) for n in counts.values())
        dealt = df.repartitionByRange(files, *partition_by, *sort_by)
    (
        dealt.sortWithinPartitions(*partition_by, *sort_by)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(current_path(spark, path))


def _same_shape(spark: SparkSession, path: str, source: DataFrame, partition_by: str) -> None:
    """Fail when the stored columns differ from the source's."""
    stored = T.StructType([f for f in spark.read.parquet(path).schema if f.name != partition_by])
    problems = contract_problems(source.drop(partition_by), stored)
    if problems:
        raise ContractError(f"schema of {path} changed: {problems}")


# --- the feed ----------------------------------------------------------------------------------------


def feed_schema(rows: T.StructType, key: str, partition_by: str) -> T.StructType:
    """One row per changed key: its action, its partition before and after, the row before and after."""
    return T.StructType([
        rows[key],
        T.StructField("action", T.StringType()),
        T.StructField("old_partition", rows[partition_by].dataType),
        T.StructField("partition", rows[partition_by].dataType),
        T.StructField("old", rows),
        T.StructField("new", rows),
    ])


def feed_is_complete(spark: SparkSession, feed: str) -> bool:
    return exists(spark, feed + "/_SUCCESS")


def no_changes(spark: SparkSession, rows: T.StructType, key: str) -> DataFrame:
    """An empty [key, old, new]."""
    return spark.createDataFrame([], T.StructType([rows[key], T.StructField("old", rows), T.StructField("new", rows)]))


def net_changes(feeds: list[DataFrame], key: str) -> DataFrame:
    """[key, old, new] over successive feeds: each key's row before the first and after the last.

    Keys that end as they began, absent or with the same row, are left out. A single feed is read where it lies;
    of several the outcome is written once, so that whoever takes it may read it more than once.
    """
    if len(feeds) == 1:
        net = feeds[0].select(key, "old", "new")
    else:
        numbered = [feed.select(key, "old", "new", F.lit(n).alias("_n")) for n, feed in enumerate(feeds)]
        whole = numbered[0]
        for feed in numbered[1:]:
            whole = whole.unionByName(feed)
        ends = whole.groupBy(key).agg(
            F.min_by(F.struct("old"), "_n").alias("first"), F.max_by(F.struct("new"), "_n").alias("last")
        )
        net = ends.select(key, F.col("first.old").alias("old"), F.col("last.new").alias("new"))
    net = net.filter(~F.col("old").eqNullSafe(F.col("new")))
    return net if len(feeds) == 1 else settle(net, "changes")


# --- the merge ---------------------------------------------------------------------------------------


def merge_by_key(
    path: str,
    source: DataFrame,
    key: str,
    partition_by: str,
    keep_smallest: str | None = None,
    key_fixes_partition: bool = False,
    target_filter: Column | None = None,
    sort_by: tuple[str, ...] = (),
    removed: DataFrame | None = None,
    feed: str | None = None,
) -> MergeResult:
    """Insert rows with a new key, replace rows with a known one, drop those with a ``removed`` key.

    ``source`` holds each key once, ``removed`` (a column named like the key) none of them. With
    ``keep_smallest`` a known row is replaced only by one with a smaller value in that column; otherwise the
    source always wins. ``key_fixes_partition`` says that equal keys always lie in equal partitions, which
    prunes the target to the source's partitions (and must not be set with ``removed``); ``target_filter``
    prunes it where matches are known to be impossible elsewhere.

    The target's key column is read once, joined with the source's keys; a small source is broadcast, so
    the target is not shuffled. Without known keys the source is appended as it is. Only partitions that
    lose or gain a replaced row are rewritten: their new versions are written aside and moved in once all
    are complete. Doing the same merge again after a crash leads to the same table.

    ``feed`` names a folder for the changes (`feed_schema`). It is complete before the table is touched. A merge
    that finds it complete was interrupted and only brings the table to what the feed says. A table that does
    not exist yet is written without a feed: all of its rows are new.
    """
    spark = source.sparkSession
    recover(spark, path)
    if not exists(spark, path):
        # A write that stops half way leaves no table behind.
        first = path.rstrip("/") + ".first"
        remove(spark, first)
        write_partitioned(source, first, [partition_by], "overwrite", sort_by)
        swap_in(spark, first, path)
        stored = read_table(spark, path, source.schema)
        counts = _counts(stored, partition_by)
        large = {p for p, n in counts.items() if p is not None and n > ROWS_PER_FILE} if sort_by else set()
        if large:  # known only now: these are laid out by range
            rows = stored.filter(F.col(partition_by).isin(sorted(large)))
            _rewrite(spark, path, rows, partition_by, sort_by, large, {p: counts[p] for p in large})
        return MergeResult(sum(counts.values()), 0)
    if feed is not None and feed_is_complete(spark, feed):
        return apply_feed(spark, path, feed, source.schema, key, partition_by, sort_by)
    _same_shape(spark, path, source, partition_by)

    folder = fresh_path(spark, "merge")
    source = settle(source, "source", folder, DENSE)
    offered = _counts(source, partition_by)
    target = read_table(spark, path, source.schema)
    known = target if target_filter is None else target.filter(target_filter)
    if key_fixes_partition:
        known = known.filter(F.col(partition_by).isin(list(offered)))

    order = [F.col(keep_smallest).alias("_old_order")] if keep_smallest else []
    old = known.select(F.col(key), F.col(partition_by).alias("_old_partition"), *order)
    action = F.lit("update")
    if keep_smallest:
        # "same": put there by an earlier attempt at this merge, so nothing is left to write.
        new = F.col(keep_smallest)
        action = F.when(new < F.col("_old_order"), "update").when(new == F.col("_old_order"), "same").otherwise("skip")
    narrow = source.select(key, partition_by, *([keep_smallest] if keep_smallest else []))
    matches = narrow.join(old, key).select(key, partition_by, "_old_partition", action.alias("_action"))
    if removed is not None:
        nowhere = F.lit(None).cast(source.schema[partition_by].dataType).alias(partition_by)
        gone = old.join(removed.select(key).distinct(), key, "left_semi")
        matches = matches.unionByName(gone.select(key, nowhere, "_old_partition", F.lit("delete").alias("_action")))
    matches = settle(matches, "matches", folder, DENSE)
    tally = matches.groupBy("_action", "_old_partition", partition_by).count().collect()

    changed = [r for r in tally if r["_action"] in ("update", "delete")]
    matched = Counter()
    for r in tally:
        matched[r[partition_by]] += r["count"] if r["_action"] != "delete" else 0
    inserts = {p: n - matched[p] for p, n in offered.items() if n > matched[p]}
    rewritten = {r[c] for r in changed for c in ("_old_partition", partition_by)} - {None}
    fresh = source
    idle_in = {r[partition_by] for r in tally if r["_action"] in ("same", "skip")}
    if idle_in:  # only there are rows to be left out
        idle = matches.filter("_action IN ('same', 'skip')").select(key)
        rest = source.filter(_lies_in(partition_by, idle_in)).join(idle, key, "left_anti").select(*source.columns)
        fresh = source.filter(~_lies_in(partition_by, idle_in)).unionByName(rest)
    touched = F.col(partition_by).isin(sorted(rewritten))
    lost = matches.filter("_action IN ('update', 'delete')").select(key, "_action", "_old_partition")
    # The rows of all partitions to be rewritten, those that go with what becomes of them.
    held = target.filter(touched).join(lost, key, "left")
    if feed is not None and (inserts or changed):
        held = settle(held, "held", folder, DENSE) if changed else held  # for the feed and for the new versions
        _write_feed(feed, held, fresh, changed, key, partition_by)
    if rewritten:
        kept = held.filter("_action IS NULL").select(*source.columns)
        counts = Counter(_counts(target.filter(touched), partition_by)) + Counter({p: offered.get(p, 0) for p in rewritten})
        _rewrite(spark, path, kept.unionByName(fresh.filter(touched)), partition_by, sort_by, rewritten, counts)
        fresh = fresh.filter(~touched)
    if any(p not in rewritten for p in inserts):
        write_partitioned(fresh, path, [partition_by], "append", sort_by, inserts)
    remove(spark, folder)
    lies_in = set(inserts) | {r[partition_by] for r in tally if r["_action"] not in ("skip", "delete")}
    counts = Counter()
    for r in tally:
        counts[r["_action"]] += r["count"]
    return MergeResult(sum(inserts.values()), counts["update"], tuple(sorted(lies_in)), counts["delete"])


def _lies_in(column: str, values: set) -> Column:
    """Whether a column has one of some values, null among them or not; never null itself."""
    return F.coalesce(F.col(column).isin(sorted(values - {None})), F.lit(None in values))


def _write_feed(feed: str, held: DataFrame, fresh: DataFrame, changed: list, key: str, partition_by: str) -> None:
    """Only the fresh rows of partitions that gain a replaced row are joined with the rows before, which ``held`` marks.

    All others are inserted and written as they stand, without a shuffle.
    """
    row = F.struct(*[F.col(c) for c in fresh.columns])
    schema = feed_schema(fresh.schema, key, partition_by)
    new = fresh.select(key, F.col(partition_by).alias("partition"), row.alias("new"))
    gaining = {r[partition_by] for r in changed if r["_action"] == "update"}
    replacing = _lies_in("partition", gaining)
    nothing = [F.lit(None).cast(schema[c].dataType).alias(c) for c in ("old_partition", "old")]
    changes = new.filter(~replacing).select("*", F.lit("insert").alias("action"), *nothing)
    if changed:
        old_partitions = sorted({r["_old_partition"] for r in changed})
        before = held.filter(F.col("_action").isNotNull() & F.col(partition_by).isin(old_partitions))
        before = before.select(key, "_action", F.col("_old_partition").alias("old_partition"), row.alias("old"))
        joined = new.filter(replacing).join(before, key, "full").withColumn("action", F.coalesce("_action", F.lit("insert")))
        changes = changes.unionByName(joined.drop("_action"))
    changes.select(*schema.fieldNames()).write.mode("overwrite").option("compression", DENSE).parquet(feed)


def _counts(rows: DataFrame, partition_by: str) -> dict:
    """Rows per partition; of a stored table only the footers are read."""
    return {r[partition_by]: r["count"] for r in rows.groupBy(partition_by).count().collect()}


def _rewrite(
    spark: SparkSession, path: str, rows: DataFrame, partition_by: str, sort_by: tuple[str, ...], touched: set, counts: Mapping
) -> None:
    run = uuid.uuid4().hex
    write_partitioned(rows, staging(path, run), [partition_by], "overwrite", sort_by, counts)
    switch_partitions(spark, path, run, touched)


def read_feed(spark: SparkSession, feed: str, rows: T.StructType, key: str, partition_by: str) -> DataFrame:
    return spark.read.schema(feed_schema(rows, key, partition_by)).parquet(feed)


def apply_feed(
    spark: SparkSession, path: str, feed: str, rows: T.StructType, key: str, partition_by: str, sort_by: tuple[str, ...] = ()
) -> MergeResult:
    """Bring a table to what a complete feed says, however much of it was done before.

    All partitions the feed names are rewritten: their rows without the feed's keys, and the feed's rows.
    """
    recover(spark, path)
    changes = read_feed(spark, feed, rows, key, partition_by)
    tally = changes.groupBy("action", "old_partition", "partition").count().collect()
    partitions = {r[c] for r in tally for c in ("old_partition", "partition")} - {None}
    touched = F.col(partition_by).isin(sorted(partitions))
    held = read_table(spark, path, rows).filter(touched)
    kept = held.join(changes.select(key), key, "left_anti")
    new = changes.filter("new IS NOT NULL").select("new.*")
    counts, sizes = Counter(), Counter(_counts(held, partition_by))
    for r in tally:
        counts[r["action"]] += r["count"]
        sizes[r["partition"]] += r["count"]
    del sizes[None]
    _rewrite(spark, path, kept.select(*rows.fieldNames()).unionByName(new), partition_by, sort_by, partitions, sizes)
    lies_in = {r["partition"] for r in tally} - {None}
    return MergeResult(counts["insert"], counts["update"], tuple(sorted(lies_in)), counts["delete"])
