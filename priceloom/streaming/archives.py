"""Landed archives to bronze slots, as Structured Streaming micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql.streaming import StreamingQuery

from priceloom.sources.slots import ingest


def ingest_stream(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    checkpoint: str,
    source_url: Column | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Parse every archive of every slot not yet in bronze, then stop.

    New files only say that there is something to do: a micro-batch takes all slots that wait, each
    with all of its archives, so the result does not depend on which files make up a batch. Slots that
    exist are left alone, so a repeated batch changes nothing. A file that drifted fails the run once
    the other slots are written; after it was replaced the next run takes its slot up.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    ingest(spark, raw_root, bronze_root, source_url)  # what an earlier run left waiting starts no batch
    return (
        reader.load(raw_root)
        .writeStream.foreachBatch(lambda _, __: ingest(spark, raw_root, bronze_root, source_url) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
