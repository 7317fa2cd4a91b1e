"""How many stations ask which price: counts per region, fuel and price that can be taken back.

The latest prices move on with the fact's feed. Each station that asks another price takes one from the count
of the old and adds one to that of the new, so the counts, which are small whatever the number of stations,
always equal those of all latest prices. Mean, deviation, exact quartiles and both ranks follow from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from priceloom.contracts import MEASURE, PRICE
from priceloom.operators.joins import enrich
from priceloom.operators.picking import pick_one
from priceloom.operators.ranking import attach_ranks, ranks_of_counts
from priceloom.plans.fact import FactLog
from priceloom.plans.marts import GROUP, RANKING
from priceloom.plans.progress import PAIR, PRICES, next_latest
from priceloom.session import settle
from priceloom.storage import current_path, exists, note_of, replace_table

COUNTED = [*GROUP, "prix_euro"]
QUARTILES = {"prix_p25_approx": 0.25, "prix_median_approx": 0.5, "prix_p75_approx": 0.75}


def named_prices(rows: DataFrame, places: DataFrame, fuels: DataFrame) -> DataFrame:
    """Latest prices with the names under which they are counted, null where there is no region."""
    dims = [
        (places.select("localisation_sk", "region_nom"), ["localisation_sk"], "left"),
        (fuels.select("carburant_sk", "carburant_nom"), ["carburant_sk"], "left"),
    ]
    return enrich(rows, dims).select(*PRICES, *GROUP)


def price_counts(named: DataFrame) -> DataFrame:
    """[region_nom, carburant_nom, prix_euro, stations] over all latest prices."""
    return _counted(named).groupBy(*COUNTED).agg(F.count(F.lit(1)).alias("stations"))


def _counted(named: DataFrame) -> DataFrame:
    return named.dropna(subset=GROUP).select(*COUNTED)


def moved_counts(counts: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The counts after some named prices, ``before``, have become others, ``after``.

    A count below zero would mean that a price goes which never came: that stops the job.
    """
    side = lambda rows, by: _counted(rows).withColumn("stations", F.lit(by).cast("bigint"))
    moved = side(before, -1).unionByName(side(after, 1)).groupBy(*COUNTED).agg(F.sum("stations").alias("stations"))
    summed = counts.select(*COUNTED, "stations").unionByName(moved).groupBy(*COUNTED).agg(F.sum("stations").alias("stations"))
    below = F.raise_error(F.lit("a price left the counts that never came")).cast("bigint")
    left = F.when(F.col("stations") > 0, F.col("stations")).otherwise(below)
    return summed.filter("stations <> 0").withColumn("stations", left)


def advance_latest(
    spark: SparkSession,
    latest_path: str,
    counts_path: str,
    fact: DataFrame,
    log: FactLog,
    places: DataFrame,
    fuels: DataFrame,
    basis: str = "",
) -> tuple[DataFrame, DataFrame]:
    """The latest price per station and fuel, and the counts, moved on by the fact's feed.

    Only the pairs that the feed names are looked at. A latest price is stored with the names it is counted
    under, so it leaves the same count it entered, whatever has become of its place since. The counts take their
    place first and both carry the number of the update they hold; whatever a crash leaves apart is counted
    anew. ``basis`` stands for the naming of regions and fuels: under another one all starts over.
    """
    order = [F.col("maj_timestamp_utc").desc()]
    generation, number = log.reached()
    now = {"generation": generation, "number": number, "basis": basis}
    notes = [note_of(spark, p) if exists(spark, p) else {} for p in (latest_path, counts_path)]
    read = lambda path: spark.read.parquet(current_path(spark, path))
    if notes == [now, now] and generation:
        return read(latest_path), read(counts_path)
    changes = None
    if notes[0] and notes[0]["basis"] == basis:
        changes = log.changes_after(notes[0]["generation"], notes[0]["number"])
    if changes is None:
        newest = pick_one(fact.select(*PRICES), PAIR, order)
        latest = replace_table(named_prices(newest, places, fuels), latest_path, now)
        return latest, replace_table(price_counts(latest), counts_path, now)

    stored = read(latest_path)
    sides = [changes.filter(F.col(n).isNotNull()).select(*[F.col(f"{n}.{c}") for c in PAIR]) for n in ("old", "new")]
    pairs = settle(sides[0].unionByName(sides[1]).distinct(), "pairs")
    before = settle(stored.join(pairs, PAIR, "left_semi"), "before")
    newest = next_latest(before.select(*PRICES), changes, fact, PAIR, order, "maj_timestamp_utc")
    after = settle(named_prices(newest, places, fuels), "after")
    counts = None
    if notes[1] == notes[0]:
        counts = replace_table(moved_counts(read(counts_path), before, after), counts_path, now)
    kept = stored.join(pairs, PAIR, "left_anti")
    latest = replace_table(kept.select(*PRICES, *GROUP).unionByName(after), latest_path, now)
    if counts is None:
        counts = replace_table(price_counts(latest), counts_path, now)
    return latest, counts


def group_ranks(counts: DataFrame) -> DataFrame:
    """One row per (region, fuel, price): stations, and the price's rank from either end."""
    return settle(
        ranks_of_counts(counts, GROUP, "prix_euro", "stations", "rang_moins_cher_region", "rang_plus_cher_region"), "ranks"
    )


def stats_of_ranks(ranks: DataFrame, quartiles: dict[str, float] | None = None) -> DataFrame:
    """Statistics per region and fuel, exact quantiles among them: the least price that so many do not exceed."""
    quartiles = QUARTILES if quartiles is None else quartiles
    n = F.col("stations")
    least = ranks.groupBy(*GROUP).agg(F.min("prix_euro").alias("_least"), F.sum("stations").alias("_all"))
    rows = ranks.join(least, GROUP)
    # Deviations are summed from the group's least price on, so no digits cancel.
    above = (F.col("prix_euro") - F.col("_least")).cast("double")
    upto = F.col("rang_moins_cher_region") - 1 + n
    quantiles = [F.min(F.when(upto >= F.col("_all") * q, F.col("prix_euro"))).alias(c) for c, q in quartiles.items()]
    summed = rows.groupBy(*GROUP).agg(
        F.sum("stations").alias("count_stations"),
        F.sum((F.col("prix_euro") * n.cast("decimal(12,0)")).cast("decimal(22,3)")).cast("decimal(24,3)").alias("_sum"),
        F.min("prix_euro").alias("prix_min"), F.max("prix_euro").alias("prix_max"),
        F.sum(above * n).alias("_first"), F.sum(above * above * n).alias("_second"), *quantiles,
    )
    count = F.col("count_stations")
    mean = (F.col("_sum") / count.cast("decimal(12,0)")).cast(MEASURE)
    variance = F.greatest(F.col("_second") - F.col("_first") * F.col("_first") / count, F.lit(0.0)) / (count - 1)
    return summed.select(
        *GROUP, "count_stations", mean.alias("prix_moyen"), F.col("prix_min").cast(PRICE).alias("prix_min"),
        F.col("prix_max").cast(PRICE).alias("prix_max"),
        F.when(count > 1, F.sqrt(variance)).cast(MEASURE).alias("prix_ecart_type"), *quartiles,
    )


def ranking_of_ranks(latest: DataFrame, ranks: DataFrame, stats: DataFrame) -> DataFrame:
    """Latest prices with both ranks and the gap to the regional mean; only (group, price) rows meet them."""
    means = stats.select(*GROUP, F.col("prix_moyen").alias("_mean"))
    gap = (F.col("prix_euro") - F.col("_mean")).cast(MEASURE).alias("ecart_prix_vs_moyenne_region")
    told = ranks.join(means, GROUP).select(*COUNTED, "rang_moins_cher_region", "rang_plus_cher_region", gap)
    return attach_ranks(latest.filter("region_nom IS NOT NULL"), told, GROUP, "prix_euro").select(*RANKING)
