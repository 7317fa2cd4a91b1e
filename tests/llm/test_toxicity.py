import random

import pytest

from priceloom.llm import toxicity
from tests.llm.data import DOCS, documents, prose

LEXICON = toxicity.Lexicon({"moron ": 5.0, "chiia": 4.0}, ["trash moron"], cut=0.2)  # folded: l and i are one


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("you moron", ["moron"]), ("you MORON!!", ["MORON"]), ("m0r0n", ["m0r0n"]), ("mоrоn", ["mоrоn"]), ("ｍｏｒｏｎ", ["ｍｏｒｏｎ"]),
        ("mo​ron", ["moron"]), ("chllado ch1lado achlla", ["chlla", "ch1la"]), ("oxymoron moronic", []), ("moron###", ["moron"]),
        ("trash moron here", []), ("trash. moron", ["moron"]), ("", []), ("mórön", ["mórön"]),
    ],
)
def test_hits(text, found):
    clean = toxicity.INVISIBLE.sub("", text)
    assert [clean[s:e] for s, e, _ in toxicity.hits(LEXICON.automaton(), clean)] == found


def test_folding_keeps_positions():
    text = "Ａé1$ß​л😀ﬁ"
    assert len(toxicity.fold_text(text)) == len(text)


def corpus(rng, n):
    texts, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(20, 120)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zonkhead", "fl1bber", "flibber", "blarg" + rng.choice(["s", "ing", "o"])]))
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def test_learnt_lexicon_parts_held_out_texts(spark):
    rng = random.Random(1)
    texts, labels = corpus(rng, 240)
    docs = documents(spark, texts + [None, "", prose(rng, 20_000), texts[0]], extra=[(0, texts[0], "en", "s", 1, 0.0, "x")])
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels) if i < 180], "doc_id long, label int")
    lexicon = toxicity.learn(docs, marks)
    assert {t.rstrip() for t in lexicon.terms} >= {toxicity.fold_text("zonkhead"), toxicity.fold_text("flibber")}
    rows = toxicity.score(docs, lexicon).collect()
    assert len(rows) == 245
    got = {r["doc_id"]: r for r in rows}
    assert [got[i]["predicted"] for i in range(240)] == labels
    assert got[240]["score"] == got[241]["score"] == got[242]["score"] == 0.0 and got[243]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 for r in rows)
    kept = toxicity.remove_toxic(docs, lexicon)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in range(243) if i >= 240 or not labels[i]}


def test_phrases_of_clean_texts_are_exceptions(spark):
    rng = random.Random(2)
    texts, labels = corpus(rng, 200)
    for i in (1, 2, 3, 5, 6):
        texts[i] += " zonkhead cabbage"
    lexicon = toxicity.learn(documents(spark, texts), spark.createDataFrame(list(enumerate(labels)), "doc_id long, label int"))
    assert toxicity.fold_text("zonkhead cabbage") in lexicon.exceptions
    assert toxicity.density(lexicon.automaton(), "a zonkhead cabbage")[1] == 0


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, label int")
    lexicon = toxicity.learn(spark.createDataFrame([], DOCS), empty)
    assert lexicon.terms == {} and toxicity.score(spark.createDataFrame([], DOCS), lexicon).count() == 0
    assert [r["score"] for r in toxicity.score(documents(spark, ["moron", None]), lexicon).collect()] == [0.0, 0.0]
