"""New bronze files to the price fact, as Structured Streaming micro-batches."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from priceloom.contracts import BRONZE, SLOT
from priceloom.fixed_values import SOURCE_TIMEZONE
from priceloom.plans.fact import follow_silver
from priceloom.plans.silver import fold_new_slots
from priceloom.storage import exists


def build_stream(
    spark: SparkSession,
    bronze_root: str,
    silver_path: str,
    fact_path: str,
    checkpoint: str,
    late: str = "drop",
    files_per_batch: int | None = None,
    zone: str = SOURCE_TIMEZONE,
) -> StreamingQuery:
    """Process every finished slot not folded before, then stop.

    New files only say that there is something to do: a micro-batch folds all finished slots that wait,
    whole, and moves the watermark once for all of them, so the result does not depend on which files
    make up a batch. Silver and the fact are stored, so no state grows inside the stream and a repeated
    batch changes nothing. The fact follows the feed of silver's changes. Events first seen at or before the fact's watermark are dropped, as in the
    batch build, or merged with ``late="merge"``.
    """
    if late not in ("drop", "merge"):
        raise ValueError(f"late must be drop or merge, not {late!r}")
    reader = spark.readStream.schema(T.StructType([*BRONZE, *SLOT])).option("pathGlobFilter", "*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def fold() -> None:
        fold_new_slots(spark, bronze_root, silver_path, zone)
        if exists(spark, silver_path):
            follow_silver(spark, silver_path, fact_path, zone, late)

    fold()  # what an earlier run left waiting starts no batch
    return (
        reader.parquet(bronze_root)
        .writeStream.foreachBatch(lambda _, __: fold())
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
