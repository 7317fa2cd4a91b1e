"""Helpers the text operators share."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Six characters separate words, nothing else: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def fold_text(text: Column, folds: int) -> Column:
    """crc32 of a text, modulo ``folds``."""
    return F.crc32(text.cast("binary")) % folds


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return fold_text(doc_id.cast("string"), folds)


def fold_of(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def apart(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until ``df`` has no such column (case aside)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def row_keys(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of all columns but maps, which have none: equal rows have equal ones, others practically never."""
    columns = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]
    present = [c.isNull() for c in columns]
    return F.xxhash64(*columns, *present), F.xxhash64(F.lit(1), *columns, *present)


def map_rows(df: DataFrame, columns: list[str], schema: str, row: Callable[..., tuple]) -> DataFrame:
    """``row(*values) -> tuple`` for each row of ``columns``, one value in memory at a time."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [row(*(v.as_py() for v in values)) for values in zip(*batch.columns, strict=True)]
            cells = list(zip(*out, strict=True)) or [[] for _ in target]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cells, target, strict=True)], schema=target
            )

    return df.select(*columns).mapInArrow(run, schema)
