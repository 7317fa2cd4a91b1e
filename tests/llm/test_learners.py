import random

from priceloom.llm import language_id, quality_vote
from tests.llm.data import DOCS, documents, prose


def test_language_of_held_out_texts(spark):
    rng = random.Random(1)
    langs = [rng.choice(["en", "de", "fr"]) for _ in range(120)]
    texts = [prose(rng, 80, lang) for lang in langs]
    odd = [None, "", "123 !!", "a", prose(rng, 20_000, "de"), "É", "日本"]
    docs = documents(spark, texts + odd + texts[:1], langs=[*langs[:90], *[None] * 38])
    filters = language_id.learn(docs)
    assert filters.languages == ["de", "en", "fr"]
    got = {r["doc_id"]: r for r in language_id.identify(docs, filters).collect()}
    right = sum(got[i]["lang_pred"] == langs[i] for i in range(90, 120))
    assert right >= 29
    assert [got[120 + i]["lang_pred"] for i in range(3)] == ["und"] * 3 and got[124]["lang_pred"] == "de"
    assert {got[i]["lang_pred"] for i in (123, 125, 126)} <= {"de", "en", "fr"}
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == 128


def test_filters_hold_what_was_put_in():
    import numpy as np

    rng = np.random.default_rng(1)
    sets = {f"l{n}": rng.integers(0, 2**63, 3000).astype(np.uint64) for n in range(11)}  # two bytes of languages
    filters = language_id.Filters.build(sets)
    for n, name in enumerate(filters.languages):
        shares = filters.shares(sets[name])
        assert shares[n] == 1.0 and np.delete(shares, n).max() < 0.02


def test_no_languages(spark):
    filters = language_id.learn(spark.createDataFrame([], DOCS))
    assert [r["lang_pred"] for r in language_id.identify(documents(spark, ["abc", None]), filters).collect()] == ["und", "und"]
    assert language_id.identify(spark.createDataFrame([], DOCS), filters).count() == 0


def test_quality_of_held_out_texts(spark):
    rng = random.Random(2)

    def junk(k):
        words = prose(rng, 40).split()
        return [" ".join(w for w in words for _ in range(8)), " ".join(w.upper() + "!!" for w in words), " | ".join(words)][k % 3]

    labels = [int(i % 3 > 0) for i in range(150)]
    texts = [prose(rng, rng.randint(30, 90)) + "." if y else junk(i // 3) for i, y in enumerate(labels)]
    docs = documents(spark, texts + [None, "", "x " * 20_000])
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels) if i < 100] + [(0, 0)], "doc_id long, label int")
    voters = quality_vote.learn(docs, marks)
    got = {r["doc_id"]: r for r in quality_vote.score(docs, voters).collect()}
    assert sum(got[i]["predicted"] == labels[i] for i in range(100, 150)) >= 48
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == 153
    assert got[150]["score"] == got[151]["score"]


def test_no_votes(spark):
    empty = spark.createDataFrame([], DOCS)
    voters = quality_vote.learn(empty, spark.createDataFrame([], "doc_id long, label int"))
    assert [r["score"] for r in quality_vote.score(documents(spark, ["abc", None]), voters).collect()] == [0.5, 0.5]
    assert quality_vote.score(empty, voters).count() == 0
