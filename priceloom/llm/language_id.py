"""Language by bit-sliced Bloom filters of character n-grams.

Slot i of the table holds one bit per language, so the ``and`` of an n-gram's slots gives all languages
whose filter holds it at once. The bits are counted per language over a whole text, corrected for each
filter's false positives, and compared with how much of its own texts a filter holds.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from priceloom.llm.sampling import first_by_hash
from priceloom.session import settle

SIZE = 4
#: log2 of the number of slots; with 20,000 n-grams a language and two slots each, a filter errs on 2 %.
SLOT_BITS = 18
#: Documents learnt from and n-grams kept for each language.
SAMPLE, GRAMS = 400, 20_000
UNKNOWN = "und"
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


@cache
def _letters() -> np.ndarray:
    """For each code point whether it is a letter, by rule of the Unicode categories."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)])


def grams(text: str) -> tuple[np.ndarray, bool]:
    """Hashes of the text's n-grams with at least two letters, and whether it has any letter.

    Case is ignored and whatever is no letter counts as one mark, as do the ends of the text.
    """
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.uint64), False
    codes = np.where(letter, codes, 0).astype(np.uint64)
    n = len(codes) - SIZE + 1
    if n <= 0:
        return np.zeros(0, np.uint64), True
    total = np.zeros(n, np.uint64)
    count = np.zeros(n, np.int8)
    for k in range(SIZE):
        total = total * np.uint64(0x100000001B3) + codes[k : k + n]
        count += letter[k : k + n]
    total = total[count >= 2] * _MIX[0]
    total ^= total >> np.uint64(29)
    return total * _MIX[1], True


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - SLOT_BITS)
    return (hashes * _MIX[2]) >> shift, (hashes * _MIX[3]) >> shift


@dataclass
class Filters:
    """``table[slot]`` has a bit for each language, in bytes of eight languages."""

    languages: list[str] = field(default_factory=list)
    table: np.ndarray | None = None
    false_rate: np.ndarray | None = None
    #: Share of the n-grams of its own sample that each filter holds.
    own_share: np.ndarray | None = None

    @staticmethod
    def build(sets: dict[str, np.ndarray]) -> Filters:
        names = sorted(sets)
        table = np.zeros((1 << SLOT_BITS, -(-len(names) // 8) or 1), np.uint8)
        for n, name in enumerate(names):
            for slot in _slots(sets[name]):
                table[slot, n // 8] |= np.uint8(1 << n % 8)
        filled = np.array([(table[:, n // 8] >> n % 8 & 1).mean() for n in range(len(names))])
        return Filters(names, table, filled**2, np.ones(len(names)))

    def shares(self, hashes: np.ndarray) -> np.ndarray:
        """Share of the n-grams each language holds, without the expected false positives."""
        first, second = _slots(hashes)
        found = self.table[first] & self.table[second]
        counts = np.concatenate([np.bincount(found[:, b], minlength=256) @ _BITS for b in range(found.shape[1])])
        rate = self.false_rate
        held = (counts[: len(self.languages)] / len(hashes) - rate) / np.maximum(1 - rate, 1e-9)
        return np.clip(held, 0, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language, and how far it is ahead of the next: 1 if no other language holds anything."""
        hashes, any_letter = grams(text or "")
        if not any_letter or not self.languages:
            return UNKNOWN, 0.0
        if not len(hashes):
            return self.languages[0], 0.0
        held = self.shares(hashes) / self.own_share
        best = int(np.argmax(held))
        if held[best] <= 0:
            return self.languages[best], 0.0
        other = np.max(np.delete(held, best), initial=0.0)
        return self.languages[best], float(held[best] / (held[best] + other))


_BITS = (np.arange(256)[:, None] >> np.arange(8)[None, :] & 1).astype(np.int64)


def learn(rows: DataFrame, sample: int = SAMPLE, most: int = GRAMS) -> Filters:
    """Filters of every language in ``rows`` (doc_id, text, lang).

    From at most ``sample`` rows a language, by hash of the id, each filter takes the ``most`` n-grams
    that the most texts hold, two at least if there are that many texts. Rows without a language or a
    letter teach nothing; without rows there are no languages and every prediction is ``und``.
    """
    known = rows.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    ids = settle(first_by_hash(known.select("doc_id", "lang").distinct(), "lang", sample), "chosen")
    texts = settle(known.join(ids, ["doc_id", "lang"]).select("lang", "text").where(F.col("text").isNotNull()), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(*batch.columns, strict=True):
                found = np.unique(grams(text.as_py())[0]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(found), pa.string()), pa.array(found)], ["lang", "gram"])

    held = texts.mapInArrow(run, "lang string, gram long").groupBy("lang", "gram").agg(F.count("*").alias("texts"))
    sizes = {r["lang"]: r["count"] for r in texts.groupBy("lang").count().collect()}
    few = [lang for lang, n in sizes.items() if n < 10]
    common = held.where((F.col("texts") > 1) | F.col("lang").isin(few)) if few else held.where(F.col("texts") > 1)
    order = Window.partitionBy("lang").orderBy(F.desc("texts"), "gram")
    best = common.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)
    lists: dict[str, list[int]] = {}
    for lang, gram in best.select("lang", "gram").collect():  # at most languages x most
        lists.setdefault(lang, []).append(gram)
    filters = Filters.build({lang: np.array(found, np.int64).view(np.uint64) for lang, found in lists.items()})
    if filters.languages:
        filters.own_share = _own_shares(texts, filters)
    return filters


def _own_shares(texts: DataFrame, filters: Filters) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, shares = [], []
            for lang, text in zip(*batch.columns, strict=True):
                hashes = grams(text.as_py())[0]
                if len(hashes) and lang.as_py() in filters.languages:
                    names.append(lang.as_py())
                    shares.append(float(filters.shares(hashes)[filters.languages.index(lang.as_py())]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(shares, pa.float64())], ["lang", "share"])

    found = texts.select("lang", "text").mapInArrow(run, "lang string, share double")
    mean = dict(found.groupBy("lang").agg(F.percentile_approx("share", 0.5)).collect())
    return np.array([max(mean.get(lang) or 1.0, 0.05) for lang in filters.languages])


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs`` (doc_id, text), from whole texts.

    Null texts and texts without a letter are ``und`` with score 0; ties go to the smaller name.
    Repeated rows are judged each; other columns are ignored; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # 2 ** SLOT_BITS bytes for eight languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
