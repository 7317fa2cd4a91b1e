"""Table contracts and the operators that enforce them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()
_NTZ, _DATE, _BOOL = T.TimestampNTZType(), T.DateType(), T.BooleanType()
PRICE = T.DecimalType(10, 3)
#: Silver takes any price the feed can hold: a strange one warns, and only gold is narrow.
WIDE_PRICE = T.DecimalType(18, 3)
MEASURE = T.DecimalType(28, 9)


class ContractError(RuntimeError):
    """A table does not have the columns and types its contract names."""


def _table(*fields: tuple) -> T.StructType:
    """``("name", type)`` is nullable, ``("name", type, "!")`` is not."""
    return T.StructType([T.StructField(f[0], f[1], len(f) == 2) for f in fields])


BRONZE = _table(
    ("station_id", _S), ("cp", _S), ("ville", _S), ("adresse", _S), ("pop", _S),
    ("latitude", _D), ("longitude", _D), ("carburant_id", _S), ("carburant_nom", _S),
    ("maj_timestamp", _NTZ), ("prix_euro", _D), ("ingestion_ts", T.TimestampType()), ("source_url", _S),
)
SLOT = _table(("dt", _S), ("hh", _S))

SILVER = _table(
    ("prix_sk", _S, "!"), ("station_id", _S, "!"), ("cp", _S), ("ville", _S), ("adresse", _S), ("pop", _S),
    ("latitude", _D), ("longitude", _D), ("carburant_id", _S, "!"), ("carburant_nom", _S),
    ("maj_timestamp_utc", _NTZ, "!"), ("prix_euro", WIDE_PRICE, "!"), ("ingestion_ts", _NTZ), ("source_url", _S),
)
DIM_CARBURANT = _table(
    ("carburant_sk", _S, "!"), ("carburant_id", _S, "!"), ("carburant_nom", _S, "!"),
    ("carburant_libelle_long", _S, "!"),
)
DIM_DATE = _table(
    ("date_sk", _I, "!"), ("full_date", _DATE, "!"), ("year", _I, "!"), ("quarter", _I), ("month", _I, "!"),
    ("month_name_fr", _S, "!"), ("day_of_month", _I), ("day_of_week", _I, "!"), ("day_name_fr", _S, "!"),
    ("iso_week", _I, "!"), ("is_weekend", _BOOL, "!"),
    ("is_working_day", _BOOL, "!"),
)
DIM_LOCALISATION = _table(
    ("localisation_sk", _S, "!"), ("cp", _S), ("ville", _S), ("dept_code", _S), ("dept_nom", _S), ("region_nom", _S),
)
DIM_STATION = _table(
    ("station_sk", _S, "!"), ("localisation_sk", _S, "!"), ("station_id", _S, "!"), ("cp", _S), ("ville", _S),
    ("adresse", _S), ("pop", _S), ("latitude", _D), ("longitude", _D),
)
FCT_PRIX_CARBURANT = _table(
    ("prix_sk", _S, "!"), ("station_sk", _S, "!"), ("carburant_sk", _S, "!"), ("date_sk", _I, "!"),
    ("localisation_sk", _S, "!"), ("prix_euro", PRICE, "!"), ("maj_timestamp_utc", _NTZ, "!"),
    ("ingestion_ts", _NTZ, "!"), ("ingestion_date", _DATE, "!"),
)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project exactly the contract's columns, each with an explicit cast."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract])


def contract_problems(df: DataFrame, contract: T.StructType) -> list[tuple[str, str]]:
    """``(column, problem)`` for each missing, extra or mistyped column. Looks at schemas only."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in contract}
    problems = [(name, "missing") for name in want if name not in have]
    problems += [(name, "extra") for name in have if name not in want]
    problems += [
        (name, f"expected {kind.simpleString()}, found {have[name].simpleString()}")
        for name, kind in want.items()
        if name in have and have[name] != kind
    ]
    return problems


def check_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The problems as a DataFrame[column, problem]."""
    return df.sparkSession.createDataFrame(contract_problems(df, contract), "column string, problem string")


def require_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return ``df``; raise when its names or types differ from the contract."""
    problems = contract_problems(df, contract)
    if problems:
        raise ContractError("; ".join(f"{name}: {what}" for name, what in problems))
    return df


def guard_not_null(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Make the job that writes ``df`` fail on a null in a NOT NULL column, without a second pass."""

    def guarded(field: T.StructField) -> Column:
        column = F.col(field.name)
        if field.nullable:
            return column
        stop = F.raise_error(F.lit(f"NOT NULL violated: {field.name}")).cast(field.dataType)
        return F.coalesce(column, stop).alias(field.name)

    return df.select(*[guarded(f) for f in contract])


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the rows in which every named column is present."""
    return df.dropna(subset=columns)
