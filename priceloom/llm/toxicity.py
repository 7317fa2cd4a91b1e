"""Toxicity by a weighted lexicon, matched after undoing look-alike characters and digit substitutions.

The lexicon holds whole words and word beginnings, learnt with their weights from labelled rows. An
Aho-Corasick automaton finds them all in one pass over the folded text; phrases in which a term is
harmless are exceptions. The summed weight is normalised by the text's length.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from priceloom.llm.sampling import first_by_hash
from priceloom.session import settle

# Characters that look like a Latin letter, and what stands for a letter in disguised words.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԝ": "w", "г": "r",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "s",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "£": "l"}
# Insults looked for from the start. They enter the lexicon on ordinary evidence (5 %) where any
# other token must stand out among all tokens of the sample.
SEEDS = """
    asshole bastard clown coward cretin despicable disgusting dumb filthy fool freak garbage hate idiot idiotic imbecile
    jerk liar loser lunatic moron nasty pathetic pig rat scum shut stupid trash ugly useless vermin vile worthless
""".split()
INVISIBLE = re.compile("[­​-‏⁠﻿]")
#: Word beginnings of these lengths may be terms.
STEMS = range(4, 9)
_WORD = re.compile(r"[^\W_]+(?:[@$!|€£][^\W_]+)*")


def _table() -> dict[int, str]:
    table = {}
    ranges = [(0x41, 0x5B), (0xC0, 0x250), (0x1E00, 0x1F00), (0x2460, 0x2500), (0xFF01, 0xFF5F), (0x1D400, 0x1D800)]
    for code in (c for low, high in ranges for c in range(low, high)):
        plain = unicodedata.normalize("NFKD", chr(code))[0].lower()
        if plain.isascii() and plain.isalnum():
            table[code] = plain
    for sign, letter in {**LOOK_ALIKES, **SUBSTITUTES}.items():
        table[ord(sign)] = letter
        if len(sign.upper()) == 1:
            table[ord(sign.upper())] = letter
    # One class for what is written alike: i, l, 1, | and !.
    return {code: letter.replace("l", "i") for code, letter in table.items()} | {ord("l"): "i", ord("L"): "i"}


FOLDED = _table()


def fold_text(text: str) -> str:
    """As long as ``text``: each character by the letter it stands for."""
    return text.translate(FOLDED)


@dataclass
class Lexicon:
    """``terms``: folded word (ends in a space) or word beginning, and its weight. ``cut``: where score is 0.5."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    cut: float = 1.0

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(term.rstrip(" "), (len(term.rstrip(" ")), term.endswith(" "), weight))
        for phrase in self.exceptions:
            folded = fold_text(phrase)
            found.add_word(folded, (len(folded), True, 0.0))
        if not len(found):
            return None
        found.make_automaton()
        return found


def hits(found: ahocorasick.Automaton, text: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the terms at word beginnings, one for each, without those in an exception."""
    terms: dict[int, tuple[int, float]] = {}
    harmless: list[tuple[int, int]] = []
    last = len(text)
    for at, (length, whole, weight) in found.iter(fold_text(text)):
        start, end = at - length + 1, at + 1
        if start and text[start - 1].isalpha() or whole and end < last and text[end].isalpha():
            continue
        if not weight:
            harmless.append((start, end))
        elif start not in terms or terms[start][1] < weight:
            terms[start] = (end, weight)
    return [
        (s, e, w) for s, (e, w) in sorted(terms.items()) if not any(a <= s and e <= b for a, b in harmless)
    ]


def density(found: ahocorasick.Automaton | None, text: str) -> tuple[float, int]:
    """Summed weight over the root of the number of words, and the number of hits."""
    if found is None or not text:
        return 0.0, 0
    text = INVISIBLE.sub("", text)
    got = hits(found, text)
    if not got:
        return 0.0, 0
    return sum(w for _, _, w in got) / math.sqrt(len(text.split()) or 1), len(got)


# --- learning ----------------------------------------------------------------------------------------


def _tokens(text: str) -> set[str]:
    out = set()
    for word in {fold_text(w) for w in set(_WORD.findall(INVISIBLE.sub("", text)))}:
        out.add(word + " ")
        out.update(word[:n] for n in STEMS if n < len(word))
    return out


def _counts(sample: DataFrame) -> DataFrame:
    """(token, toxic, clean): texts of the sample that hold the token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(*batch.columns, strict=True):
                seen[label.as_py()].update(_tokens(text.as_py()))
        names = list(seen[0] | seen[1])
        for start in range(0, len(names), 50_000):
            part = names[start : start + 50_000]
            columns = [pa.array(part)] + [pa.array([seen[k][x] for x in part], pa.int64()) for k in (1, 0)]
            yield pa.RecordBatch.from_arrays(columns, ["token", "toxic", "clean"])

    rows = sample.select("text", "label").mapInArrow(run, "token string, toxic long, clean long")
    return rows.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _minhash(text: Column) -> Column:
    """The least hash of the five-word shingles in four hash orders: near copies mostly share one."""

    @F.pandas_udf("array<long>")
    def run(texts):
        def least(text: str) -> list[int]:
            words = text.encode().split()
            grams = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
            hashes = np.fromiter((xxhash.xxh64_intdigest(g) for g in grams), np.uint64, len(grams))
            return [int((hashes * np.uint64(2 * k + 1) ^ np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)).min().view(np.int64)) for k in range(4)]

        return texts.map(least)

    return run(text)


def _pick(rows: list, clean: int, toxic: int, tokens: int) -> dict[str, float]:
    """Terms that stand out beyond chance among ``tokens`` tokens, without those that another one covers."""
    total = clean + toxic
    scored = []
    seeds = {fold_text(word) + " " for word in SEEDS}
    for token, t, c in rows:
        expected_t, expected_c = (t + c) * toxic / total, (t + c) * clean / total
        g = t * math.log(t / expected_t) + (c * math.log(c / expected_c) if c else 0.0)
        odds = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        if odds >= 2 and g >= math.log((1 if token in seeds else tokens) / 0.05):
            scored.append((-g, not token.endswith(" "), -len(token), token, odds))
    terms: dict[str, float] = {}
    for _, _, _, token, odds in sorted(scored):
        stem = token.rstrip(" ")
        covered = token in terms or any(stem[:n] in terms for n in STEMS if n <= len(stem))
        covers = not token.endswith(" ") and any(t.startswith(stem) for t in terms)
        if not covered and not covers:
            terms[token] = odds
    return terms


def learn(docs: DataFrame, marks: DataFrame, toxic_rows: int = 3000, clean_rows: int = 9000) -> Lexicon:
    """A lexicon from ``docs`` (doc_id, text) and ``marks`` (doc_id, label 0/1).

    At most so many documents of each label are taken, by hash of the id; only ids are shuffled to find
    them. Near copies in the sample count once. Without toxic rows the lexicon is empty and all scores are 0.
    """
    known = docs.select("doc_id").join(marks.select("doc_id", "label"), "doc_id").distinct()
    chosen = settle(first_by_hash(known, "label", {1: toxic_rows, 0: clean_rows}), "chosen")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("length(text) > 0")
    rows = texts.groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("row")).select("doc_id", "row.*")
    sample = settle(rows.withColumn("keys", _minhash(F.col("text"))), "sample")
    for k in range(4):
        first = F.min(F.struct("doc_id", "text", "label", "keys")).alias("row")
        sample = sample.groupBy(F.col("keys")[k]).agg(first).select("row.*")
    sample = settle(sample.select("text", "label"), "sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return Lexicon()
    counted = settle(_counts(sample), "tokens")
    tokens = counted.count()
    share = toxic / (toxic + clean)
    # The best a token can do is to be in toxic texts alone; what cannot stand out even so isn't collected.
    least = max(2, math.ceil(math.log(tokens / 0.05) / math.log(1 / share))) if clean else 2
    seeds = [fold_text(word) + " " for word in SEEDS]
    top = counted.where(((F.col("toxic") >= least) | F.col("token").isin(seeds)) & (F.col("toxic") > 4 * share / max(1 - share, 1e-9) * F.col("clean")))
    rows = top.orderBy(F.desc("toxic"), "clean", "token").limit(50_000).collect()
    lexicon = Lexicon(_pick([tuple(r) for r in rows], clean, toxic, tokens))
    lexicon.exceptions = _exceptions(sample, lexicon)
    lexicon.cut = _cut(sample, lexicon)
    return lexicon


def _exceptions(sample: DataFrame, lexicon: Lexicon) -> list[str]:
    """Two-word phrases round a term that at least three clean texts hold and no toxic one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = lexicon.automaton()
        names: list[str] = []
        labels: list[int] = []
        for batch in batches:
            for cell, label in zip(*batch.columns, strict=True):
                text = INVISIBLE.sub("", cell.as_py())
                phrases = set()
                for start, end, _ in hits(found, text) if found else []:
                    before, after = re.search(r"[^\W_]+\W$", text[max(0, start - 40) : start]), re.match(r"\w*\W[^\W_]+", text[end : end + 60])
                    phrases |= {x for x in (before and before[0] + text[start:end], after and text[start:end] + after[0]) if x}
                names += [fold_text(x) for x in phrases]
                labels += [label.as_py()] * len(phrases)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(labels, pa.int32())], ["phrase", "label"])

    rows = sample.select("text", "label").mapInArrow(run, "phrase string, label int").groupBy("phrase").agg(
        F.count(F.when(F.col("label") == 0, 1)).alias("clean"), F.sum("label").alias("toxic")
    )
    rows = rows.where("clean >= 3 AND toxic = 0").orderBy(F.desc("clean"), "phrase").limit(1000)
    return [r["phrase"] for r in rows.collect()]


def _cut(sample: DataFrame, lexicon: Lexicon) -> float:
    """The density that parts the labels with the fewest errors."""
    rows = [(r["density"], r["label"]) for r in measure(sample, lexicon).select("density", "label").collect()]
    values = np.array(sorted({d for d, _ in rows if d > 0} | {0.0}))
    if len(values) < 2:
        return 1.0
    cuts = (values[1:] + values[:-1]) / 2
    at = np.array([d for d, _ in rows])
    label = np.array([y for _, y in rows])
    clean, toxic = np.sort(at[label == 0]), np.sort(at[label == 1])
    errors = len(clean) - np.searchsorted(clean, cuts) + np.searchsorted(toxic, cuts)
    return float(cuts[np.argmin(errors)])


# --- scoring -----------------------------------------------------------------------------------------


def measure(rows: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``rows`` without ``text``, with density and hits; null texts count as empty."""
    rest = [c for c in rows.columns if c != text]
    schema = rows.select(*rest).schema.add("density", "double").add("hits", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = lexicon.automaton()
        for batch in batches:
            got = [density(found, t.as_py() or "") for t in batch.column(0)]
            columns = batch.columns[1:] + [pa.array([d for d, _ in got], pa.float64()), pa.array([n for _, n in got], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return rows.select(text, *rest).mapInArrow(run, schema)


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, score, predicted, hits) per row of ``docs`` (doc_id, text).

    score = d / (d + cut) for a text of density d: 0 without hits, 0.5 at the cut. Null and empty texts
    have score 0. Repeated rows are scored each; other columns are ignored; an empty table gives none.
    """
    found = measure(docs.select("doc_id", "text"), lexicon)
    value = F.col("density") / (F.col("density") + F.lit(lexicon.cut))
    return found.select("doc_id", value.alias("score"), (value >= 0.5).cast("int").alias("predicted"), "hits")


def remove_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows of ``docs`` whose text is not toxic, all columns as they are."""
    at, cut = docs.columns.index("text"), lexicon.cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = lexicon.automaton()
        for batch in batches:
            keep = [density(found, t.as_py() or "")[0] < cut for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
