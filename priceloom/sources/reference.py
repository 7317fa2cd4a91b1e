"""Reference data: given CSV files or the fixed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from priceloom.fixed_values import DEPARTMENTS, FUELS


def read_reference_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with a header, all columns as text, so that ``01`` and ``2A`` survive."""
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def fuels(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The 6 fuels, or those of a CSV."""
    return _given_or_fixed(spark, path, ["carburant_id", "carburant_nom", "carburant_libelle_long"], FUELS)


def departments(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The 101 departments, or those of a CSV."""
    return _given_or_fixed(spark, path, ["dept_code", "dept_nom", "region_nom"], DEPARTMENTS)


def _given_or_fixed(spark: SparkSession, path: str | None, columns: list[str], rows: list[tuple]) -> DataFrame:
    if path:
        return read_reference_csv(spark, path, columns)
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
