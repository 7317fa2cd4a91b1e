import math

import numpy as np
import pytest

from priceloom.llm.near_vectors import near_vectors, quantised
from priceloom.llm.top_k import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string, kept int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 1) for i, v, y in rows], SCHEMA)


def awkward(rng, n=160, size=12):
    centres = rng.normal(size=(6, size))
    rows = []
    for i in range(n):
        v = centres[i % 6] + rng.normal(size=size) * rng.choice([0.02, 0.1, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 2))))
    odd = [None, [], [0.0] * size, [math.nan] * size, [math.inf] + [1.0] * (size - 1), [None] + [1.0] * (size - 1), [1.0, 2.0], [1e-30] * size, [1e30] * size]
    rows += [(n + k, v, 0) for k, v in enumerate(odd)] + [(n + 50 + k, rows[0][1], None) for k in range(2)]
    rows += [(n + 60, rows[3][1], rows[3][2]), (n + 61, [5 * x for x in rows[3][1]], rows[3][2])]
    return rows


def good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("tile", [4096, 20])
def test_links_and_components(spark, tile):
    rows = awkward(np.random.default_rng(5))
    found = {r["vec_id"]: r for r in near_vectors(table(spark, rows), 0.98, tile=tile).collect()}
    links = {i: set() for i, _, _ in rows}
    for i, v, y in rows:
        for j, w, z in rows:
            if i < j and y is not None and y == z and good(v) and good(w) and len(v) == len(w):
                a, b = np.array(v) / max(map(abs, v)), np.array(w) / max(map(abs, w))
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98:
                    links[i].add(j)
                    links[j].add(i)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            todo += [x for x in links[todo.pop()] if x not in seen and not seen.add(x)]
        got = found[i]
        assert (got["n_links"], got["component_id"], got["kept"]) == (len(links[i]), min(seen), i == min(seen)), i
    assert len(found) == len(rows) and any(links.values())


def test_the_bound_holds():
    rng = np.random.default_rng(2)
    v = rng.normal(size=(200, 16)) * rng.exponential(size=(200, 16))
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    codes, scale, held, error = quantised(v)
    about = (codes.astype(int) @ codes.T.astype(int)) * scale[:, None] * scale[None, :]
    bound = held[:, None] * error[None, :] + error[:, None] * (held + error)[None, :]
    assert (np.abs(unit @ unit.T - about) <= bound + 1e-12).all()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_vectors(empty).count() == 0
    assert top_k(empty, lambda i: i % 2 == 0).count() == 0


@pytest.mark.parametrize("block", [8192, 16])
def test_top_k_equals_all_products(spark, block, monkeypatch):
    from priceloom.llm import top_k as module

    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "STEP", 8)
    rng = np.random.default_rng(7)
    rows = [(i, v, y) for i, v, y in awkward(rng, 90) if not (v and any(x and abs(x) > 1e20 for x in v if x))]
    rows += [(900 + k, rows[0][1], 1) for k in range(8)]  # ties
    found = {}
    for r in top_k(table(spark, rows), lambda i: i % 10 == 0).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    whole = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    for q in [i for i in whole if i % 10 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q)[:5]
        assert [found[q][n] for n in sorted(found[q])] == [(i, -s) for s, i in scores]
    assert set(found) == {i for i in whole if i % 10 == 0}


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [-1.0, 0.0], 1)]
    found = top_k(table(spark, rows), lambda i: i == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in found] == [(1, 1, 256 * 128), (2, 2, -256 * 256)]


@pytest.mark.parametrize("k", [1, 5])
def test_large_components_take_part(spark, k):
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in rng.normal(size=3)], 1) for i in range(40)]
    rows += [(100, [300_000.0, 0.0, 0.0], 1), (101, [300_000.0, 0.0, 0.0], 1), (102, [0.0, -(2.0**40), 1.0], 1), (103, [1e30, 0.0, 0.0], 1)]
    rows += [(110, [0.0, 0.0, 2.0], 1), (120, [3e5, 2.0, -1.0], 1)]
    rows = [r for r in rows if r[0] != 103] if k == 5 else rows
    whole = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v, _ in rows}
    asks = lambda i: i in (110, 120) or i < 40 and i % 10 == 0
    if k == 1:  # 1e30 meets only zeros in the one query
        asks = lambda i: i == 110
    found = {}
    condition = (lambda i: i.isin(110)) if k == 1 else (lambda i: i.isin(110, 120) | (i < 40) & (i % 10 == 0))
    for r in top_k(table(spark, rows), condition, k=k).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for q in filter(asks, whole):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q)[:k]
        assert [found[q][n] for n in sorted(found[q])] == [(i, -s) for s, i in scores], q
    assert set(found) == set(filter(asks, whole))


def test_a_score_beyond_a_long_stops_the_job(spark):
    rows = [(0, [1e12, 0.0], 1), (1, [1e12, 1.0], 1), (2, [0.0, 1.0], 1)]
    with pytest.raises(Exception, match="beyond a long: query 0, vector 1"):
        top_k(table(spark, rows), lambda i: i == 0).collect()
    assert [r["vec_id"] for r in top_k(table(spark, rows), lambda i: i == 2).orderBy("rank").collect()] == [1, 0]


def test_rows_without_an_id(spark):
    rows = [(0, [1.0, 0.0], 1), (None, [9.0, 0.0], 1), (1, [2.0, 0.0], 1)]
    assert [r["vec_id"] for r in top_k(table(spark, rows), lambda i: i == 0).collect()] == [1]
