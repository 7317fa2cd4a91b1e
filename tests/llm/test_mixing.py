import random
import re

import pytest
from pyspark.sql import functions as F

from priceloom.llm import mixing
from tests.llm.data import DOCS, documents, prose


def fill(sizes, weights, share, most):
    """Targets by filling again and again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    free, out = set(order), {}
    while free:
        left = share * sum(sizes.values()) - sum(out.values())
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s] + 1e-9]
        if not over:
            out |= {s: level * weight[s] for s in free}
            break
        for s in over:
            out[s] = most * sizes[s]
            free.discard(s)
    return out


def table(spark):
    rng = random.Random(5)
    names = ["a", "B", "é", "zz", "", None, "b1"]
    texts, sources = [], []
    for i in range(400):
        sources.append(rng.choice(names) if i % 3 else "B")
        texts.append(prose(rng, rng.choice([1, 5, 40, 40, 40, 80])))
    texts += [None, "", " \n", "w " * 20_000]
    sources += ["a", "a", None, "zz"]
    return documents(spark, texts, sources=sources, extra=[(0, texts[0], "en", sources[0], 1, 0.0, "x"), (None, "x y", None, "a", 3, 0.0, "x")])


def test_mix(spark):
    docs = table(spark)
    rows = mixing.mix(docs, [3, 1, 2]).collect()
    sizes, taken = {}, {}
    largest = {}
    for r in rows:
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    want = fill(sizes, [3, 1, 2], 1.5, 2.0)
    assert len(rows) == docs.count()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] and len(r["positions"]) == r["copies"]
        assert all(0 <= p <= 1 for p in r["positions"]) and r["positions"] == sorted(r["positions"])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= min(0.02 * want[s] + 80, largest[s]) if largest[s] < 1000 else abs(taken[s] - want[s]) <= largest[s] / 2, s
    first = [r["positions"][0] for r in rows if r["copies"]]
    assert first == sorted(first)
    again = mixing.mix(docs.repartition(7), [3, 1, 2]).collect()
    key = lambda r: (str(r["doc_id"]), r["row_key"], r["copies"], tuple(r["positions"]))
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_demand_is_inverted(spark):
    rows = spark.createDataFrame([(c / 10, t) for c in range(11) for t in (-0.5, 0.0, 0.5)], "c double, tilt double")
    at = rows.select("c", "tilt", mixing.place(F.col("c") * 70, F.lit(70.0), F.col("tilt")).alias("t")).collect()
    for r in at:
        assert r["t"] + r["tilt"] * (r["t"] ** 2 - r["t"]) == pytest.approx(r["c"])


def test_training_order_repeats_rows_as_taken(spark):
    docs = table(spark)
    mixed = mixing.mix(docs, [3, 1, 2]).collect()
    rows = mixing.training_order(docs, [3, 1, 2])
    assert rows.columns == docs.columns
    got = {}
    for r in rows.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    want = {}
    for r in mixed:
        if r["copies"]:
            want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"]
    assert got == want


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 0, "b": 5}, {"a": 1, "b": 1000, "c": 3, None: 7}, {"a": 5, "b": 5, "c": 5, "d": 5}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows, [3, 1, 2]).collect()}
    assert got == pytest.approx(fill(sizes, [3, 1, 2], 1.5, 2.0))


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mix(empty, [3, 1, 2]).count() == mixing.training_order(empty, [3, 1, 2]).count() == 0


def test_any_column_name(spark):
    names = ["_key", "_id", "_position", "_last", "_base", "_tokens", "_spans", "_walked", "_clean", "row", "copies"]
    docs = documents(spark, ["one text of words", "password = hunter2hunter2", None, ""])
    docs = docs.withColumns({n: F.concat(F.lit(n), "doc_id") for n in names})
    got = mixing.training_order(docs, [3, 1, 2], share=1.0)
    assert got.columns == docs.columns and got.count() >= 1
    assert all(r[n] == f"{n}{r['doc_id']}" for r in got.collect() for n in names)
