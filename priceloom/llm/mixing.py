"""Mixing sources to target weights along a curriculum.

Every source's weight changes over training, from (1 - tilt) to (1 + tilt) times its mean. The integral
of that schedule is the source's cumulative token demand; the tokens of its documents, in an order by
hash, are laid against it, and inverting the demand gives each document its place in training.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from priceloom.llm.text import WORD, apart
from priceloom.session import settle

#: Documents of one source are summed in parts of about so many, then within a part.
PART = 2_000
#: A document above this share of its source's target comes after the others, so that none of the last taken is large.
HEAVY = 1 / 64
#: No source and no document is taken more often.
MOST = 2.0


def running(rows: DataFrame, order: list[Column], sums: dict[str, Column], parts: int = 64) -> DataFrame:
    """``rows`` with columns ``sums``: sums over all rows up to this one in ``order``, which must be total.

    Rows are dealt out by range; one window runs over the sums of the parts, one within each part, so
    no task sees all rows.
    """
    dealt = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    dealt = settle(dealt, "ranges")  # the parts must not change between the two sums
    whole = dealt.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("_part", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    dealt = dealt.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()})
    return dealt.join(whole, "_part").select(*rows.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums])


def targets(sizes: DataFrame, weights: list[int], share: float = 1.5, most: float = MOST) -> DataFrame:
    """(source, source_size, weight, nth, target) from (source, source_size): shares of ``share`` x all sizes.

    Sources take ``weights`` in turn, by code point, a null source last. A target above ``most`` x its
    source stops there and the excess is shared again by weight. That fill level is found without
    iterating: sources stop in the order of room per weight, so the first one that the level of all
    later ones leaves room divides them.
    """
    order = [F.col("source").isNull(), F.col("source")]
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("nth") - 1) % len(weights) + 1).cast("int"))
    ranked = running(sizes.select("source", "source_size"), order, {"nth": F.lit(1)})
    ranked = ranked.withColumn("weight", cycle.cast("long")).withColumn("room", F.col("source_size") * F.lit(most))
    ratio = F.col("room") / F.col("weight")
    filled = running(
        ranked.withColumn("ratio", ratio),
        [F.col("ratio"), F.col("nth")],
        {"room_to": F.col("room"), "weight_to": F.col("weight")},
    )
    filled = settle(filled, "sources")
    all_size, all_weight = filled.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    # What each weight gets if all sources with less room per weight stop.
    left = F.lit(float(all_size * share)) - (F.col("room_to") - F.col("room"))
    level = left / (F.lit(all_weight) - (F.col("weight_to") - F.col("weight")))
    levels = filled.withColumn("level", level).where("ratio >= level")
    fill = levels.agg(F.min_by("level", F.struct("ratio", "nth"))).first()[0]
    target = F.least(F.col("room"), F.col("weight") * F.lit(float("inf") if fill is None else fill))
    return filled.select("source", "source_size", "weight", "nth", target.cast("double").alias("target"))


def place(cumulative: Column, target: Column, tilt: Column) -> Column:
    """The time in 0..1 at which a source's demand target * (t + tilt * (t * t - t)) reaches ``cumulative``."""
    x = F.when(target > 0, F.least(cumulative / target, F.lit(1.0))).otherwise(F.lit(0.0))
    slope = 1 - tilt
    root = F.sqrt(slope * slope + 4 * tilt * x)
    return F.when(F.abs(tilt) < 1e-9, x).otherwise(2 * x / (slope + root))


def row_key(docs: DataFrame) -> Column:
    """A hash of all columns but maps, which have none."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"])


def mix(
    docs: DataFrame, weights: list[int], share: float = 1.5, tilts: tuple[float, ...] = (0.5, 0.0, -0.5), seed: int = 7
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, positions, row_key), range-sorted by first position.

    size is the number of words; a null text has none. Every source's documents are put in an order by
    hash; whole passes over the source and the part of a last one up to the target are taken, each
    document as a whole: the one that crosses the end is taken if at least half of it fits.
    ``positions`` holds a place in 0..1 for each copy, by the source's schedule: the n-th source has
    tilt ``tilts[n % len]``. Reruns agree. Repeated rows are documents of their own; a null source is a
    source; documents without words are taken zero times, as are all of an empty table. Other columns
    only enter ``row_key``, the hash by which `training_order` finds the rows again.
    """
    sized = docs.select(
        F.col("doc_id"), F.col("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_key(docs).alias("row_key"),
    )
    # Rows in an order by hash of all they hold: many with one id, or without, still spread over all parts.
    sized = settle(sized.withColumn("_order", F.xxhash64(F.lit(seed), "row_key")), "sizes")
    parts = max(1, -(-sized.count() // PART))
    aims = settle(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share), "aims")
    rows = sized.join(aims.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    part = F.pmod("_order", F.lit(parts)) + F.when(F.col("size") > F.col("target") * HEAVY, parts).otherwise(0)
    rows = settle(rows.withColumn("_part", part.cast("long")), "parts")
    by_part = rows.groupBy("source", "_part").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select(
        F.col("source").alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("source", "_part").orderBy("_order", "doc_id", "size", "row_key")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(settle(offsets, "offsets"), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
    middle = F.col("_before") + F.col("_inside") + F.col("size") / 2
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - passes * F.col("source_size")
    copies = F.when(F.col("size") > 0, passes + (middle <= rest).cast("long")).otherwise(F.lit(0)).cast("int")
    tilt = F.element_at(F.array(*[F.lit(float(t)) for t in tilts]), ((F.col("nth") - 1) % len(tilts) + 1).cast("int"))
    nth_copy = lambda k: place(k * F.col("source_size") + middle, F.col("target"), tilt)
    rows = rows.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), nth_copy))
        .otherwise(F.array().cast("array<double>")).alias("positions"), "row_key",
    )
    first = F.col("positions").getItem(0)
    return rows.withColumn("_first", F.when(F.col("copies") > 0, first)).sort(F.asc_nulls_last("_first"), "doc_id").drop("_first")


def training_order(docs: DataFrame, weights: list[int], **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, sorted by their places in training.

    Equal rows are interchangeable: one of them is repeated for all of their places. Null ids, texts and sources
    are taken as `mix` takes them; columns keep their names, whatever they are; an empty table gives none.
    """
    placed = mix(docs, weights, **options).where("copies > 0")
    # The key, which covers the id, tells a null id from the number that stands for it here. Plain equality on both
    # columns lets the join use the partitioning of the step before: texts are shuffled once for both.
    key, known, position, last = apart(docs, "_key", "_id", "_position", "_last")
    id_of = F.coalesce("doc_id", F.lit(0))
    places = placed.select(F.col("row_key").alias(key), id_of.alias(known), F.explode("positions").alias(position), F.col("doc_id").alias(last))
    rows = docs.withColumns({key: row_key(docs), known: id_of}).dropDuplicates([key, known]).join(places, [key, known])
    return rows.sort(position, last).select(*[F.col(f"`{c}`") for c in docs.columns])
