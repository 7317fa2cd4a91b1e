"""Declared checks over one table.

All checks of a table are counted in one pass over it. Row checks are plain counts. The keys of all
uniqueness and reference checks are stacked as (check, hashes of the key) rows, beside the parents' keys, and
counted together: combined per key in every task, then summed per key, then per check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from priceloom.operators.joins import orphans
from priceloom.operators.key_counts import Key, stacked
from priceloom.operators.picking import duplicate_keys

_RESULT = ["check", "column", "severity", "failures", "status"]


class QualityGateError(RuntimeError):
    """A check of severity ``error`` found failing rows."""


@dataclass(frozen=True)
class Check:
    """One rule. ``breach`` is the condition of a failing row, for row checks."""

    name: str
    columns: tuple[str, ...]
    severity: str = "error"
    breach: Column | None = None
    parent: DataFrame | None = None
    parent_column: str | None = None

    @property
    def column(self) -> str:
        return ",".join(self.columns)


def not_null(column: str, severity: str = "error") -> Check:
    return Check("not_null", (column,), severity, F.col(column).isNull())


def accepted(column: str, values: list, severity: str = "error") -> Check:
    """Values outside the list fail; nulls pass."""
    return Check("accepted_values", (column,), severity, ~F.col(column).isin(values))


def holds(column: str, expression: str, severity: str = "error") -> Check:
    """``expression`` follows the column, as in ``between 0.5 and 3.5``; null passes."""
    return Check(f"expression: {expression}", (column,), severity, ~F.expr(f"`{column}` {expression}"))


def not_after(column: str, as_of: Column, severity: str = "error") -> Check:
    """No value lies later than ``as_of``."""
    return Check("not_in_future", (column,), severity, F.col(column) > as_of)


def unique(*columns: str, severity: str = "error") -> Check:
    """One column: repeated values, nulls ignored. Several: repeated combinations, nulls alike."""
    return Check("unique" if len(columns) == 1 else "unique_combination", columns, severity)


def refers_to(column: str, parent: DataFrame, parent_column: str, severity: str = "error") -> Check:
    """Every non-null value exists in the parent."""
    return Check("relationships", (column,), severity, None, parent, parent_column)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows, repeated keys or orphan keys behind a check."""
    if check.breach is not None:
        return df.filter(check.breach)
    if check.parent is not None:
        return orphans(df, check.column, check.parent, check.parent_column)
    if len(check.columns) == 1:
        df = df.filter(F.col(check.column).isNotNull())
    return duplicate_keys(df, list(check.columns))


def _result(check: Check, failures: Column) -> Column:
    failures = F.coalesce(failures, F.lit(0)).cast("bigint")
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(check.column).alias("column"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
        F.when(failures == 0, "pass").when(F.lit(check.severity == "warn"), "warn").otherwise("error").alias("status"),
    )


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """DataFrame[check, column, severity, failures, status], one row per check.

    ``failures`` counts failing rows; for uniqueness, repeated keys. ``df`` is read once, and each parent once
    per reference to it.
    """
    if not checks:
        raise ValueError("no checks given")
    row_checks = {n: c for n, c in enumerate(checks) if c.breach is not None}
    key_checks = {n: c for n, c in enumerate(checks) if c.breach is None}
    counts = [F.count_if(c.breach).alias(f"f{n}") for n, c in row_checks.items()]
    if not key_checks:
        return _results(df.agg(*counts), checks)

    keys = {n: Key([F.col(c) for c in check.columns], skip_nulls=len(check.columns) == 1) for n, check in key_checks.items()}
    breaches = {f"f{n}": c.breach.cast("int") for n, c in row_checks.items()}
    rows = stacked(df, keys, breaches).withColumn("parent", F.lit(0))
    for n, check in key_checks.items():
        if check.parent is not None:
            known = F.col(check.parent_column).try_cast(df.schema[check.column].dataType)
            parents = stacked(check.parent, {n: Key([known], skip_nulls=True)}, {})
            rows = rows.unionByName(parents.withColumn("parent", F.lit(1)), allowMissingColumns=True)
    per_key = rows.groupBy("key_no", "one", "two").agg(
        F.sum(1 - F.col("parent")).alias("n"), F.max("parent").alias("parent"), *[F.sum(c).alias(c) for c in breaches]
    )
    per_check = per_key.groupBy("key_no").agg(
        F.count_if(F.col("n") > 1).alias("repeated"), F.sum(F.when(F.col("parent") == 0, F.col("n"))).alias("orphans"),
        *[F.sum(c).alias(c) for c in breaches],
    )
    of = lambda n, c: F.max(F.when(F.col("key_no") == n, F.col("orphans" if c.parent is not None else "repeated")))
    return _results(
        per_check.agg(*[F.max(c).alias(c) for c in breaches], *[of(n, c).alias(f"f{n}") for n, c in key_checks.items()]), checks
    )


def _results(counted: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check from one row with their counts f0, f1, ..."""
    rows = F.array(*[_result(check, F.col(f"f{n}")) for n, check in enumerate(checks)])
    return counted.select(F.inline(rows)).select(*_RESULT)


def raise_on_errors(results: DataFrame, table: str = "") -> list:
    """The result rows; raises when one of them has status ``error``. Warnings pass."""
    rows = results.collect()
    bad = [r for r in rows if r["status"] == "error"]
    if bad:
        found = "; ".join(f"{r['check']}({r['column']}): {r['failures']}" for r in bad)
        raise QualityGateError(f"{table}: {found}" if table else found)
    return rows
