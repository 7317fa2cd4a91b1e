"""Looking at a source before trusting it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from priceloom.fixed_values import ACCENTED_LETTERS
from priceloom.functions import fixed_point, price
from priceloom.operators.key_counts import Key, stacked


def _missing(column: str) -> Column:
    text = F.col(column).cast("string")
    return text.isNull() | (F.trim(text) == "")


def id_name_pairs(df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """Distinct (id, name) pairs with counts; a missing part shows as ``?``."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(c)
    return df.select(shown(id_col), shown(name_col)).groupBy(id_col, name_col).agg(F.count(F.lit(1)).alias("row_count"))


def in_id_order(pairs: DataFrame, id_col: str) -> DataFrame:
    """Pairs by numeric id; ids that are not numbers come last."""
    number = F.when(F.col(id_col).rlike("^[0-9]+$"), F.col(id_col).try_cast("int"))
    return pairs.orderBy(F.coalesce(number, F.lit(999)), *pairs.columns)


def field_presence(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows, missing or blank values, values with accented letters. One pass."""
    accented = f"[{ACCENTED_LETTERS}]"
    measures = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(_missing(c)).alias("missing"),
            F.count_if(F.col(c).cast("string").rlike(accented)).alias("accented"),
        )
        for c in columns
    ]
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def samples(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a defined order."""
    return df.orderBy(*order_by).limit(n)


def accented_samples(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    return samples(df.filter(F.col(column).rlike(f"[{ACCENTED_LETTERS}]")).select(column), [column], n)


def profile_feed(raw: DataFrame, n: int = 5) -> dict[str, DataFrame]:
    """What raw stations, as ``unpack`` gives them, look like; one small table per question.

    ``pairs`` fuel ids and names, ``presence`` missing fields, ``accented`` town names that survived
    decoding, ``prices`` and ``coordinates`` raw beside typed samples.
    """
    stations = raw.filter("drift IS NULL")
    prices = stations.select("station_id", F.inline("prices"))
    typed = lambda c: fixed_point(F.col(c)).alias(f"{c}_degrees")
    return {
        "files": stations.groupBy("path", "entry").agg(F.count(F.lit(1)).alias("station_count")),
        "pairs": in_id_order(id_name_pairs(prices, "id", "nom"), "id"),
        "presence": field_presence(stations, ["station_id", "cp", "ville", "adresse", "pop", "latitude", "longitude"]),
        "accented": accented_samples(stations, "ville", n),
        "prices": samples(prices, ["station_id", "id"], n).withColumn("euros", price(F.col("valeur"))),
        "coordinates": samples(stations, ["station_id"], n).select(
            "station_id", "latitude", "longitude", typed("latitude"), typed("longitude")
        ),
    }


def text_shapes(df: DataFrame, column: str) -> DataFrame:
    """How often each shape of text occurs, every digit shown as 9: a change of format stands out."""
    shape = F.regexp_replace(F.col(column).cast("string"), "[0-9]", "9").alias("shape")
    return df.groupBy(shape).agg(F.count(F.lit(1)).alias("row_count"))


def audit(df: DataFrame, measures: list[str], distinct: list[str]) -> DataFrame:
    """One row: row count, min and max of each measure, distinct count of each key. One scan for all of them."""
    if not distinct:
        return df.agg(F.count(F.lit(1)).alias("row_count"), *_ends(measures))
    keys = {n: Key([F.col(k)], skip_nulls=True) for n, k in enumerate(distinct)}
    told = {"row_count": F.lit(1).cast("bigint"), **{f"{m}_{end}": F.col(m) for m in measures for end in ("min", "max")}}
    ends = lambda: [(F.min if c.endswith("_min") else F.max)(c).alias(c) for c in told if c != "row_count"]
    per_key = stacked(df, keys, told).groupBy("key_no", "one", "two").agg(F.sum("row_count").alias("row_count"), *ends())
    counts = [F.count_if(F.col("key_no") == n).alias(f"distinct_{k}") for n, k in enumerate(distinct)]
    return per_key.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), *ends(), *counts)


def _ends(measures: list[str]) -> list[Column]:
    return [end(m).alias(f"{m}_{name}") for m in measures for name, end in (("min", F.min), ("max", F.max))]
