"""Counting many keys of one table in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Key:
    """Columns that make up a key. With ``skip_nulls`` a key with a null is none; otherwise nulls are alike."""

    columns: list[Column]
    skip_nulls: bool = False


def two_hashes(columns: list[Column]) -> tuple[Column, Column]:
    """128 bits of hash: equal values have equal ones, others practically never; nulls count as values."""
    told = [*columns, *[c.isNull() for c in columns]]
    return F.xxhash64(*told), F.xxhash64(F.lit(1), *told)


def stacked(df: DataFrame, keys: dict[int, Key], measures: dict[str, Column]) -> DataFrame:
    """[key_no, one, two, *measures]: per row one row for each key, by its number, and one numbered -1.

    Only the rows numbered -1 hold ``measures``; all of a task's combine into one.
    """
    empty = {name: F.lit(None).cast("int") for name in measures}
    kinds = dict(df.select(*[c.alias(name) for name, c in measures.items()]).dtypes) if measures else {}

    def entry(number: int, one: Column, two: Column, values: dict[str, Column]) -> Column:
        held = [values[name].cast(kinds[name]).alias(name) for name in measures]
        return F.struct(F.lit(number).alias("key_no"), one.alias("one"), two.alias("two"), *held)

    nothing = F.lit(0).cast("bigint")
    entries = [entry(-1, nothing, nothing, measures)] if measures else []
    for number, key in keys.items():
        found = entry(number, *two_hashes(key.columns), empty)
        if key.skip_nulls:
            there = F.lit(True)
            for column in key.columns:
                there &= column.isNotNull()
            found = F.when(there, found)
        entries.append(found)
    rows = df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("entry"))
    return rows.select("entry.*")
