import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from priceloom.llm import simhash
from tests.llm.data import DOCS, documents, prose


def plain_fingerprint(text, length=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, distance):
    root = {k: k for k in values}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(values)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            if (values[a] ^ values[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("text", ["", " \t\n", "One", "one TWO", "É a b  c\x1cd e", "a b c " * 5000, "É" * 30000, None])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("tile", [4096, 8])
@pytest.mark.parametrize("distance", [0, 2, 4])
def test_links_equal_all_pairs(spark, distance, tile):
    rng = random.Random(distance)
    values = [rng.getrandbits(64) for _ in range(60)]
    for base in values[:12]:  # chains of near ones, and many that share most of their bits
        for _ in range(6):
            base ^= 1 << rng.randrange(64)
            values.append(base)
    values += [values[0] & ~0xFFFF | rng.getrandbits(16) for _ in range(60)]
    values = sorted(set(values))
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    found = [(r["a"], r["b"]) for r in simhash.links(fps, distance, tile).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in found)
    want = plain_components({signed(v): v for v in values}, distance)
    root = {k: k for k in want}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in found:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {k: find(k) for k in root} == want


def test_allocation_is_the_least_costly():
    rng = np.random.default_rng(1)
    costs = np.concatenate([np.zeros((20, 3, 1)), np.cumsum(rng.random((20, 3, 3)), axis=2)], axis=2)
    got = simhash.allocate(costs, 0)
    assert (got.sum(axis=1) == 0).all()
    choices = [(a, b, -a - b) for a in range(-1, 3) for b in range(-1, 3) if -1 <= -a - b <= 2]
    for f in range(20):
        cost = lambda c: sum(costs[f, p, t + 1] for p, t in enumerate(c))
        assert cost(got[f]) == pytest.approx(min(map(cost, choices)))


def test_near_copies(spark):
    rng = random.Random(3)
    texts = [prose(rng, 400) for _ in range(12)]
    near = [t.rsplit(" ", 1)[0] + " changed" for t in texts[:4]]
    texts += near + [texts[0], texts[0].upper(), None, "", " ", "x", prose(rng, 20_000)]
    docs = documents(spark, texts)
    found = {r["doc_id"]: r for r in simhash.near_copies(docs).collect()}
    want = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r["fp"] & (2**64 - 1) for i, r in found.items()} == want
    assert {i: r["component_id"] for i, r in found.items()} == plain_components(want, 2)


def test_the_stage_keeps_the_first_of_each_group(spark):
    rng = random.Random(4)
    text, other = prose(rng, 300), prose(rng, 300)
    extra = [
        (1, "quite another text", "en", "s", 5, 0.0, "x"),  # the same id: no copy, so it stays
        (0, text, "en", "s0", len(text), 9.0, "x"),  # an equal row
        (None, text, None, None, 1, 0.0, "x"), (None, "no id", None, None, 1, 0.0, "x"), (None, "no id", None, None, 2, 0.0, "x"),
    ]
    docs = documents(spark, [text, other, text, None, ""], extra=extra)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    rows = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert rows == sorted([(0, text), (1, other), (1, "quite another text"), (3, None), (None, "no id")], key=str)


def test_the_stage_decides_alike_in_any_order(spark):
    rng = random.Random(9)
    texts = [prose(rng, 60) for _ in range(6)] * 4
    docs = documents(spark, texts, extra=[(i % 4, texts[i % 3], None, None, i, 0.0, "y") for i in range(9)])
    key = lambda df: sorted((str(tuple(r)) for r in df.collect()))
    once = key(simhash.keep_first(docs))
    assert once == key(simhash.keep_first(docs.orderBy(F.rand(3)))) and len(once) == 6


NAMES = ["_key", "_id", "_position", "_base", "_tokens", "_spans", "_walked", "one", "two", "count", "fp", "first"]


def test_any_column_name(spark):
    docs = documents(spark, ["a b c", "a b c", None]).withColumns({n: F.concat(F.lit(n), "doc_id") for n in NAMES})
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"]: [r[n] for n in NAMES] for r in kept.collect()} == {i: [f"{n}{i}" for n in NAMES] for i in (0, 2)}


def test_empty_table(spark):
    assert simhash.near_copies(spark.createDataFrame([], DOCS)).count() == 0
