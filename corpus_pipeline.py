"""From raw documents to packed training sequences.

Each stage takes (spark, docs, folder) and works on all rows its predecessor kept; what it returns is
written as Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from priceloom.llm import mixing, packing, secret_scan, simhash, toxicity
from priceloom.llm.queries import TOKENIZER, toxic_marks
from priceloom.session import settle


def remove_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the lexicon finds toxic go; all others stay as they are."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.remove_toxic(docs, toxicity.learn(docs, toxic_marks(labels)))


def remove_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents whose fingerprints are linked, the one with the smallest doc_id stays."""
    return simhash.keep_first(docs, length=3, distance=2)


def remove_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.training_order(docs, weights=[3, 1, 2], share=1.5)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents with their place in a sequence; the first of each sequence has the sequence's ids."""
    return packing.packed_pieces(docs, TOKENIZER, packing.LENGTH, [F.crc32("ids").alias("ids_crc32")], whole=True)


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash_near_copies", remove_copies),
    ("secret_scan", remove_secrets),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: The stages learn, hash and search: not SQL. Tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
