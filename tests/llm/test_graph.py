import random

from priceloom.llm.graph import components


def test_chains_stars_and_repeats(spark):
    rng = random.Random(1)
    ids = rng.sample(range(-500, 5000), 300)
    edges = [(ids[i], ids[i + 1]) for i in range(99)]  # a long chain in no order
    edges += [(ids[100], x) for x in ids[101:200]] + [(ids[150], ids[150]), (ids[201], ids[202]), (ids[202], ids[201]), (None, 3)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: min(ids[:100]) for x in ids[:100]} | {x: min(ids[100:200]) for x in ids[100:200]}
    want |= {x: min(ids[201:203]) for x in ids[201:203]}
    assert found == want


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()
