"""The learnt operators' searches against plain ones, and the sample they learn from."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from priceloom.llm import language_id, quality_vote, toxicity
from priceloom.llm.sampling import first_by_hash
from tests.llm.data import prose

# --- the lexicon: every term looked for by itself ------------------------------------------------------


def plain_hits(lexicon, text):
    folded, found, harmless = toxicity.fold_text(text), {}, []

    def places(part):
        at = folded.find(part)
        while at >= 0:
            yield at, at + len(part)
            at = folded.find(part, at + 1)

    begins = lambda s: s == 0 or not text[s - 1].isalpha()
    ends = lambda e: e >= len(text) or not text[e].isalpha()
    for term, weight in lexicon.terms.items():
        for s, e in places(term.rstrip(" ")):
            if begins(s) and (not term.endswith(" ") or ends(e)) and weight > found.get(s, (0, 0))[1]:
                found[s] = (e, weight)
    for phrase in lexicon.exceptions:
        harmless += [(s, e) for s, e in places(toxicity.fold_text(phrase)) if begins(s) and ends(e)]
    return [(s, e, w) for s, (e, w) in sorted(found.items()) if not any(a <= s and e <= b for a, b in harmless)]


def test_the_automaton_finds_what_plain_search_finds():
    rng = random.Random(1)
    fold = toxicity.fold_text
    for _ in range(60):
        words = ["".join(rng.choice("abcil") for _ in range(rng.randint(2, 5))) for _ in range(8)]
        stems = {fold(w): rng.choice([1.0, 2.0, 3.5]) + n / 100 for n, w in enumerate(words[:6])}  # a stem is one term
        terms = {stem + rng.choice(["", " "]): weight for stem, weight in stems.items()}
        lexicon = toxicity.Lexicon(terms, [f"{words[0]} {words[6]}", f"{words[7]} {words[1]}"])
        parts = [w.replace("i", rng.choice("i1!l")).replace("a", rng.choice("aа@A")) for w in words]  # one a is Cyrillic
        text = "".join(rng.choice(parts) + rng.choice(["", " ", " ", ". ", "-"]) for _ in range(60))
        assert toxicity.hits(lexicon.automaton(), text) == plain_hits(lexicon, text)


# --- the vote: every labelled text sorted by its cosine ------------------------------------------------


def test_the_vote_equals_a_full_sort():
    rng = np.random.default_rng(2)
    found = rng.random((90, quality_vote.TERMS)).astype(np.float32)  # no two at one distance from a third
    basis = np.linalg.qr(rng.normal(size=(quality_vote.TERMS, quality_vote.LATENT)))[0].astype(np.float32)
    labels, weights = rng.integers(0, 2, 60).astype(float), rng.uniform(0.5, 3, 60)
    voters = quality_vote.Voters(np.ones(quality_vote.TERMS, np.float32), basis, np.zeros((0, quality_vote.LATENT)), labels, weights)
    voters.vectors = voters.latent(found[:60])
    got = voters.vote(found)
    held, asked = voters.vectors.astype(float), voters.latent(found).astype(float)
    for n in range(len(found)):
        cosines = sorted(((float(held[m] @ asked[n]), m) for m in range(60)), reverse=True)[: quality_vote.NEIGHBOURS]
        votes = [(weights[m] * np.exp(20 * (c - 1)), labels[m]) for c, m in cosines]
        assert got[n] == pytest.approx(sum(w * y for w, y in votes) / sum(w for w, _ in votes), abs=1e-4)


# --- the filters: exact sets of n-grams ----------------------------------------------------------------


def test_filters_decide_like_exact_sets():
    rng = random.Random(3)
    langs = ("en", "de", "fr")
    sets = {lang: np.unique(np.concatenate([language_id.grams(prose(rng, 60, lang))[0] for _ in range(30)])) for lang in langs}
    filters = language_id.Filters.build(sets)
    exact = {lang: set(found.tolist()) for lang, found in sets.items()}
    for _ in range(150):
        lang = rng.choice(langs)
        text = prose(rng, rng.randint(3, 60), lang)
        hashes = language_id.grams(text)[0]
        shares = [sum(h in exact[name] for h in hashes.tolist()) / len(hashes) for name in filters.languages]
        assert np.allclose(filters.shares(hashes), shares, atol=0.12 if len(hashes) < 40 else 0.05)
        ahead = sorted(shares)
        if ahead[-1] - ahead[-2] > 0.1:
            assert filters.predict(text)[0] == filters.languages[int(np.argmax(shares))]


# --- the sample ----------------------------------------------------------------------------------------


def test_the_sample_is_what_a_full_sort_chooses(spark):
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 1000 == 1, "b").otherwise("c").alias("lang"))
    ids = ids.unionAll(spark.createDataFrame([(50_000, None)], "doc_id long, lang string"))
    got = {}
    for r in first_by_hash(ids, "lang", {"a": 100, "b": 100, "c": 7}).collect():
        got.setdefault(r["lang"], set()).add(r["doc_id"])
    want = {}
    for r in ids.where("lang IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        held = want.setdefault(r["lang"], [])
        if len(held) < {"a": 100, "b": 100, "c": 7}[r["lang"]]:
            held.append(r["doc_id"])
    assert got == {lang: set(found) for lang, found in want.items()}
    assert first_by_hash(ids.limit(0), "lang", 5).collect() == []


def test_no_task_ranks_many_more_than_are_chosen(spark):
    ids = spark.range(50_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("label"))
    chosen = first_by_hash(ids, "label", 400)
    assert chosen.count() == 400
    low = ids.where(F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5 <= (400 + 6 * 20 + 10) / 50_000).count()
    assert 400 <= low <= 700
