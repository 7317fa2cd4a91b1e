"""The registered queries and the pipeline on the driver's smallest tables."""

from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from __spark_entry__ import queries
from priceloom.llm.queries import QUERIES
from priceloom.session import settle
from priceloom.llm import secret_scan, simhash

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")

COLUMNS = {
    1: {"vec_id", "n_links", "component_id", "kept"},
    2: {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    3: {"doc_id", "held_out", "score", "predicted"},
    4: {"doc_id", "fingerprint", "component_id"},
    5: {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
    6: {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    7: {"query_id", "rank", "vec_id", "score"},
    8: {"doc_id", "held_out", "score", "predicted"},
    9: {"doc_id", "size", "source_size", "target", "taken"},
    10: {"doc_id", "held_out", "lang_pred", "score"},
    11: {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    12: {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"},
    13: {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
}
PER_ROW = {1: "embeddings", 3: "documents", 4: "documents", 6: "documents", 8: "documents", 9: "documents", 10: "documents", 11: "documents"}


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and {*QUERIES, "pipeline"} <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    number = int(name[2:].split("_")[0])
    found = QUERIES[name](spark, FOLDER)
    assert COLUMNS[number] <= set(found.columns)
    rows = found.count()
    if number in PER_ROW:
        assert rows == spark.read.parquet(f"{FOLDER}/{PER_ROW[number]}.parquet").count()
    assert rows


def test_pipeline(spark):
    docs = first = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_copies", "secret_scan", "source_mix", "best_fit_packing"
    ]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = settle(stage(spark, docs, FOLDER), name)
        if name != "best_fit_packing":
            assert docs.columns == first.columns
    clean = labels.where("toxic = 0").select("doc_id").distinct()
    assert kept["toxicity"].join(clean, "doc_id").count() == first.join(clean, "doc_id").count()
    copies = simhash.near_copies(kept["toxicity"]).where("doc_id = component_id").count()
    assert kept["simhash_near_copies"].count() == copies
    assert kept["secret_scan"].count() == copies
    assert secret_scan.scan(kept["secret_scan"]).where("size(base) > 0").isEmpty()
    mixed = Counter(r["doc_id"] for r in kept["source_mix"].select("doc_id").collect())
    packed = Counter(r["doc_id"] for r in kept["best_fit_packing"].where("piece = 0").select("doc_id").collect())
    assert mixed == packed and max(mixed.values()) <= 2
    assert corpus_pipeline.run(spark, FOLDER).count() == kept["best_fit_packing"].count()
