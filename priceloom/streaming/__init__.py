"""Micro-batch ingestion and builds."""

from priceloom.streaming.archives import ingest_stream
from priceloom.streaming.micro_batch import build_stream

__all__ = ["build_stream", "ingest_stream"]
