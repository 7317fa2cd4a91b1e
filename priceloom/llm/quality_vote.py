"""Quality by the votes of the nearest labelled documents in a latent-semantic space.

A document's terms are hashed runs of character classes (how it is written, not what it says) and
grades of how much it repeats itself. Weighted terms of a labelled sample span the space; its vectors
go to every task, and every document is compared with all of them in blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from priceloom.llm.sampling import first_by_hash
from priceloom.session import settle

TERMS, LATENT = 1024, 48
#: Labelled documents learnt from at most, in all. With LATENT numbers each they take under 2 MB.
SAMPLE = 6000
NEIGHBOURS, BLOCK = 15, 256

#: Classes of bytes: small and capital letters, digits, space, line feed, other ASCII each for itself, the rest.
_CLASS = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (
        0 if "a" <= _c <= "z" else 1 if "A" <= _c <= "Z" else 2 if "0" <= _c <= "9" else 3 if _c in " \t" else 4 if _c in "\n\r"
        else 5 if _b >= 128 else 6 + _b
    )
_GRADES = 256  # the last terms are grades; those before are hashed runs


def _grade(name: str, value: float) -> int:
    return TERMS - _GRADES + zlib.crc32(f"{name} {value:.0f}".encode()) % _GRADES


def terms(text: str) -> np.ndarray:
    """Weights of a text's terms; an empty text has its grades alone."""
    data = text.encode()
    out = np.zeros(TERMS, np.float32)
    if data:
        kind = _CLASS[np.frombuffer(data, np.uint8)]
        # A run of small letters is one mark: words of any length look alike.
        kind = kind[np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] > 2)])]
        for size in (2, 3):
            if len(kind) >= size:
                runs = kind[: len(kind) - size + 1].copy()
                for k in range(1, size):
                    runs = runs * 140 + kind[k : len(kind) - size + 1 + k]
                at = (runs * 0x9E3779B1 + size) % (TERMS - _GRADES)
                out += np.bincount(at, minlength=TERMS).astype(np.float32)
        out = np.log1p(out * np.float32(1000 / len(kind)))
    words = text.split()
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in text.split("\n") if x.strip()]
    n = len(words)
    grades = {
        "words": np.log2(n + 1),
        "word length": len(data) / max(n, 1) // 2,
        "same next": 20 * sum(map(str.__eq__, words, words[1:])) / max(n, 1),
        "pairs": 20 * pairs / max(n - 1, 1),
        "lines": 10 * len(set(lines)) / max(len(lines), 1),
        "line length": np.log2(n / max(len(lines), 1) + 1),
    }
    for name, value in grades.items():
        out[_grade(name, value)] += 3.0
    return out


def matrix(texts) -> np.ndarray:
    return np.stack([terms(t.as_py() or "") for t in texts]) if len(texts) else np.zeros((0, TERMS), np.float32)


@dataclass
class Voters:
    """``basis``: terms to latent space; ``vectors``, ``labels``, ``weights``: the labelled documents."""

    rarity: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def latent(self, found: np.ndarray) -> np.ndarray:
        made = (found * self.rarity) @ self.basis
        return made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-12)

    def vote(self, found: np.ndarray) -> np.ndarray:
        """Share of the nearest labelled documents' weights, each by its similarity, that say 1."""
        if not len(self.labels):
            return np.full(len(found), 0.5)
        out = []
        for start in range(0, len(found), BLOCK):
            cosine = self.latent(found[start : start + BLOCK]) @ self.vectors.T
            k = min(NEIGHBOURS, cosine.shape[1])
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            close = np.take_along_axis(cosine, near, axis=1)
            weight = self.weights[near] * np.exp(20 * (np.clip(close, -1, 1) - 1))
            out.append((weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1))
        return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)


def learn(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> Voters:
    """Voters from ``docs`` (doc_id, text) and ``marks`` (doc_id, label 0/1).

    Up to half of ``sample`` documents of each label are taken, by hash of the id; only ids are shuffled
    to find them. A vote counts as many documents as it stands for, so the labels keep their shares
    whatever was sampled.
    """
    known = settle(docs.select("doc_id").join(marks.select("doc_id", "label"), "doc_id").distinct(), "labelled")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = settle(first_by_hash(known, "label", {0: sample // 2, 1: sample // 2}), "chosen")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `sample` ids
    rows = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [row.tobytes() for row in matrix(batch.column(1)).astype(np.float16)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.binary())], ["label", "terms"])

    found = settle(rows.select("label", "text").mapInArrow(run, "label int, terms binary"), "terms").collect()
    labels = np.array([r["label"] for r in found], np.float64)
    held = np.frombuffer(b"".join(r["terms"] for r in found), np.float16).astype(np.float32).reshape(-1, TERMS)
    rarity = np.log((1 + len(held)) / (1 + (held > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    _, basis = np.linalg.eigh((held * rarity).T.astype(np.float64) @ (held * rarity).astype(np.float64))
    basis = np.ascontiguousarray(basis[:, ::-1][:, :LATENT]).astype(np.float32)
    stands_for = {label: counts[label] / max((labels == label).sum(), 1) for label in counts}
    voters = Voters(rarity, basis, np.zeros((0, LATENT), np.float32), labels, np.array([stands_for[y] for y in labels]))
    voters.vectors = voters.latent(held)
    return voters


def score(docs: DataFrame, voters: Voters, good: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs`` (doc_id, text); predicted is 1 from ``good`` up.

    Null and empty texts are judged by their grades. Without labelled rows every score is 0.5. Repeated
    rows are scored each; other columns are ignored; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(start, BLOCK)
                found = pa.array(shared.value.vote(matrix(piece.column(1))), pa.float64())
                yield pa.RecordBatch.from_arrays([piece.column(0), found], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
    return rows.withColumn("predicted", (F.col("score") >= good).cast("int"))
