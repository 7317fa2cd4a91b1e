"""Near copies by SimHash: the generalised pigeonhole principle over unequal thresholds.

Bits that vary together are put into one part of the fingerprint. If two fingerprints differ in at
most t bits and the thresholds of m parts sum to t - m + 1, they differ within the threshold in some
part (-1 leaves a part out). Every fingerprint gets thresholds of its own, by dynamic programming over
the candidates it must expect in each part. It then probes all values within those thresholds and the
candidates are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from priceloom.llm.graph import components
from priceloom.llm.text import apart, row_keys
from priceloom.session import settle

BITS = 64
SEED = 42
#: A probe costs as much as so many candidates.
PROBE_COST = 4.0
#: Larger buckets are verified in tiles of so many fingerprints by as many probes.
TILE = 4096


def shingle_hashes(text: bytes, length: int) -> np.ndarray:
    """XXH64 of each word shingle, words joined by one space; fewer words make one shingle, none make none."""
    # On bytes, lower() changes A-Z alone and split() knows just the six ASCII white spaces.
    found = text.lower().split()
    if not found:
        return np.zeros(0, "<u8")
    grams = zip(*(found[i:] for i in range(length)), strict=False) if len(found) >= length else [found]
    return np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in map(b" ".join, grams)), "<u8")


def fingerprint(text: bytes, length: int = 3) -> int:
    """SimHash over word shingles, repeats included; a bit is set if it is in over half of the hashes."""
    hashes = shingle_hashes(text, length)
    if not len(hashes):
        return 0
    total = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 8192):
        part = hashes[start : start + 8192].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, length: int = 3, text: str = "text", id: str = "doc_id", told: tuple[Column, ...] = ()
) -> DataFrame:
    """(doc_id, fp, ...): the fingerprint as a signed long, and longs to go with it; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), length) for t in batch.column(1)), "<u8", batch.num_rows)
            columns = [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names)

    whole = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    names = ["doc_id", "fp", *[f"told_{n}" for n in range(len(told))]]
    rows = docs.select(F.col(id).cast("long"), whole, *told)
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


# --- statistics of the bits --------------------------------------------------------------------------


def _moments(fps: DataFrame) -> tuple[float, np.ndarray]:
    """Number of fingerprints and how often two bits are set together (64 x 64, whatever their number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            own = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(own, axis=1, bitorder="little").astype(np.float32)
            n += len(bits)
            both += bits.T @ bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BITS * BITS)), pa.array(both.ravel()), pa.array(np.full(BITS * BITS, float(n)))],
            ["cell", "both", "n"],
        )

    cells = fps.select("fp").mapInArrow(run, "cell long, both double, n double").groupBy("cell").sum("both", "n").collect()
    both = np.zeros(BITS * BITS)
    for cell, value, _ in cells:
        both[cell] = value
    return (cells[0][2] if cells else 0.0), both.reshape(BITS, BITS)


def correlated_parts(both: np.ndarray, n: float, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal width, each grown by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    close = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(close, 0)
    free, found = list(range(BITS)), []
    for left in range(parts, 0, -1):
        width = len(free) // left
        first = max(free, key=lambda b: close[b, free].max())
        group = [first]
        free.remove(first)
        while len(group) < width:
            best = max(free, key=lambda b: close[b, group].mean())
            group.append(best)
            free.remove(best)
        found.append(sorted(group))
    return found


def expected_matches(both: np.ndarray, n: float, part: list[int], most: int) -> np.ndarray:
    """Chance that two fingerprints differ in exactly 0..most bits of ``part``, bits taken as independent."""
    p = np.diag(both)[part] / max(n, 1)
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for differ in 2 * p * (1 - p):
        chance = chance * (1 - differ) + np.concatenate([[0.0], chance[:-1]]) * differ
    return chance


def allocate(costs: np.ndarray, budget: int) -> np.ndarray:
    """Thresholds of least cost for many fingerprints at once: dynamic programming over the parts.

    ``costs[f, part, t + 1]`` is the cost of threshold t (from -1) in a part. Thresholds sum to ``budget``.
    """
    n, parts, choices = costs.shape
    low, span = -parts, budget + 2 * parts + 1  # sums on the way may pass the budget by what later parts give back
    best = np.full((n, span), np.inf)
    best[:, 0 - low] = 0.0
    picks = np.zeros((parts, n, span), np.int8)
    for part in range(parts):
        reached = np.full((n, span), np.inf)
        for choice in range(choices):
            step = choice - 1
            source = np.arange(span) - step
            inside = (source >= 0) & (source < span)
            cost = np.full((n, span), np.inf)
            cost[:, inside] = best[:, source[inside]] + costs[:, part, choice][:, None]
            better = cost < reached
            reached[better] = cost[better]
            picks[part][better] = step
        best = reached
    out = np.zeros((n, parts), np.int8)
    at = np.full(n, budget - low)
    rows = np.arange(n)
    for part in range(parts - 1, -1, -1):
        out[:, part] = picks[part][rows, at]
        at = at - out[:, part]
    return out


def _plan(both: np.ndarray, n: float, distance: int) -> list[list[int]]:
    """The division into parts with the least expected cost per fingerprint."""
    plans = []
    for m in range(1, distance + 3):
        groups = correlated_parts(both, n, m)
        costs = np.zeros((1, m, distance + 2))
        for i, group in enumerate(groups):
            for t, chance in enumerate(np.cumsum(expected_matches(both, n, group, distance))):
                costs[0, i, t + 1] = n * chance + PROBE_COST * sum(len(list(combinations(range(len(group)), d))) for d in range(t + 1))
        chosen = allocate(costs, distance - m + 1)[0]
        plans.append((sum(costs[0, i, t + 1] for i, t in enumerate(chosen)) + PROBE_COST * m, m, groups))
    return min(plans)[2]


# --- probe and verify --------------------------------------------------------------------------------


def _value(fps: np.ndarray, part: list[int]) -> np.ndarray:
    mask = sum(1 << b for b in part)
    return fps & np.uint64(mask)


def _flips(part: list[int], threshold: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for d in range(threshold + 1) for c in combinations(part, d)], np.uint64)


def _forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Join the labels of linked nodes until all of a component agree on the smallest."""
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        least = np.minimum(la, lb)
        np.minimum.at(label, la, least)
        np.minimum.at(label, lb, least)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _linked(own: np.ndarray, probes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct edges (as fingerprints) that connect what one bucket links; at most one per fingerprint."""
    nodes, where = np.unique(np.concatenate([own, probes]), return_inverse=True)
    index, asked = where[: len(own)], np.unique(where[len(own) :])
    label = np.arange(len(nodes))
    for start in range(0, len(asked), 256):
        chunk = asked[start : start + 256]
        near = np.bitwise_count(nodes[chunk][:, None] ^ nodes[index][None, :]) <= distance
        i, j = np.nonzero(near)
        label = _forest(len(nodes), chunk[i], index[j], label)
    moved = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[moved], nodes[label[moved]]


def verify(buckets: DataFrame, distance: int) -> DataFrame:
    """(a, b) fingerprint pairs that connect each bucket. ``buckets``: key, fp, probe; sorted by key in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple | None = None
        for batch in _with_end(batches):
            if batch is None:
                if rest is None:
                    return
                key, fp, probe = rest
                ends = np.array([len(key)])
            else:
                key, fp = (np.ascontiguousarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in (0, 1))
                probe = batch.column(2).to_numpy(zero_copy_only=False)
                if rest is not None:
                    key, fp, probe = (np.concatenate(x) for x in zip(rest, (key, fp, probe), strict=True))
                ends = np.nonzero(key[1:] != key[:-1])[0] + 1
            if not len(key):
                continue
            starts = np.concatenate([[0], ends])
            whole = starts if batch is None else starts[:-1]
            found_a, found_b = [], []
            for s, e in zip(whole[: len(ends)], ends, strict=False):
                if e - s < 2:
                    continue
                own = fp[s:e].view(np.uint64)
                role = probe[s:e]
                a, b = _linked(own[~role], own[role], distance)
                found_a.append(a)
                found_b.append(b)
            cut = ends[-1] if len(ends) else 0
            rest = (key[cut:], fp[cut:], probe[cut:])
            if found_a:
                a, b = np.concatenate(found_a).view(np.int64), np.concatenate(found_b).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return buckets.select("key", "fp", "probe").mapInArrow(run, "a long, b long")


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def links(fps: DataFrame, distance: int, tile: int = TILE) -> DataFrame:
    """(a, b) of distinct fingerprints (fp: long) whose components are those of all pairs within ``distance`` bits.

    Every linked pair is found in at least one bucket; a bucket returns a forest of its links rather
    than all pairs. A bucket above ``tile`` is dealt out as tiles, own values by probes, so one value
    that most fingerprints share fills no task.
    """
    n, both = _moments(fps)
    parts = _plan(both, n, distance)
    m = len(parts)
    ones = [_flips(part, distance) for part in parts]
    chance = [np.cumsum(expected_matches(both, n, part, distance)) for part in parts]
    probes_of = np.array([[0] + [len(_flips(p, t)) for t in range(distance + 1)] for p in parts])
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    masks = F.array(*[F.lit(signed(sum(1 << b for b in part))) for part in parts])
    spread = fps.select("fp", F.posexplode(masks).alias("part", "mask")).select(
        "fp", "part", F.col("fp").bitwiseAND(F.col("mask")).alias("value")
    )
    sizes = settle(spread.groupBy("part", "value").agg(F.count("*").alias("size")), "sizes")
    shared = sizes.where("size > 1")
    # How many share each of its values; a value of its own (the common case) has no row in `shared`.
    met = spread.join(shared, ["part", "value"]).groupBy("fp").agg(
        F.sort_array(F.collect_list(F.struct("part", "size"))).alias("met")
    )
    asked = fps.join(met, "fp", "left")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                piece = batch.slice(start, 2048)
                fp = np.ascontiguousarray(piece.column(0).to_numpy(zero_copy_only=False)).view(np.uint64)
                exact = np.ones((len(fp), m))
                for row, met_there in enumerate(piece.column(1).to_pylist()):
                    for x in met_there or []:
                        exact[row, x["part"]] = x["size"]
                costs = np.zeros((len(fp), m, distance + 2))
                for i in range(m):
                    for t in range(distance + 1):
                        far = n * (chance[i][t] - chance[i][0])
                        costs[:, i, t + 1] = exact[:, i] + far + PROBE_COST * probes_of[i][t + 1]
                chosen = allocate(costs, distance - m + 1)
                for i in range(m):
                    for t in range(distance + 1):
                        rows = np.nonzero(chosen[:, i] == t)[0]
                        if t == 0:  # a value that nobody shares finds only itself
                            rows = rows[exact[rows, i] > 1]
                        if not len(rows):
                            continue
                        flips = ones[i][: probes_of[i][t + 1]]
                        values = (_value(fp[rows], parts[i])[:, None] ^ flips[None, :]).ravel()
                        again = np.repeat(fp[rows], len(flips))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(values), i, np.int32)), pa.array(values.view(np.int64)), pa.array(again.view(np.int64))],
                            ["part", "value", "fp"],
                        )

    probes = asked.mapInArrow(probe, "part int, value long, fp long")
    probes = settle(probes.join(sizes.select("part", "value"), ["part", "value"]), "probes")
    # Only values that somebody probes need their own fingerprints. Both roles are dealt into blocks.
    in_blocks = lambda count: F.ceil(F.col(count) / F.lit(float(tile))).cast("int")
    asked = probes.groupBy("part", "value").agg(F.count("*").alias("asked"))
    wanted = settle(
        asked.join(sizes, ["part", "value"]).select("part", "value", in_blocks("size").alias("own_n"), in_blocks("asked").alias("probe_n")),
        "buckets",
    )
    dealt = lambda count: F.pmod(F.xxhash64("fp"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    own = spread.join(wanted, ["part", "value"]).withColumn("i", dealt("own_n")).withColumn("j", every("probe_n"))
    probes = probes.join(wanted, ["part", "value"]).withColumn("j", dealt("probe_n")).withColumn("i", every("own_n"))
    own = own.select("part", "value", "i", "j", "fp", F.lit(False).alias("probe"))
    probes = probes.select("part", "value", "i", "j", "fp", F.lit(True).alias("probe"))
    rows = own.unionAll(probes).select(F.xxhash64("part", "value", "i", "j").alias("key"), "fp", "probe")
    # Two buckets whose keys collide are verified as one: links stay right, since every pair is checked.
    return verify(rows.repartition("key").sortWithinPartitions("key"), distance)


def near_copies(
    docs: DataFrame, length: int = 3, distance: int = 2, text: str = "text", id: str = "doc_id", tile: int = TILE
) -> DataFrame:
    """(doc_id, fp, component_id): documents linked by fingerprints that differ in at most ``distance`` bits.

    Texts are lower-cased in A-Z, split at ASCII white space, and shingled by ``length`` words. Null
    and empty texts have fingerprint zero and link like any other. component_id is the smallest doc_id
    reachable. Copies are first reduced to one row per fingerprint. Repeated doc_ids give one row each;
    an empty table gives none; other columns are ignored; a null id keeps its row and never names a
    component unless all ids of it are null.
    """
    marked = settle(fingerprints(docs, length, text, id), "fingerprints")
    least = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    edges = links(least.select("fp"), distance, tile)
    grouped = components(edges)
    named = least.join(grouped.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    first = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = named.join(first, "component").select("fp", "component_id")
    return marked.join(ids, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, length: int = 3, distance: int = 2) -> DataFrame:
    """One row of each group of near copies: that with the smallest doc_id, null last, then by a hash of the row.

    Decided per row, whatever ids repeat: rows of one id with texts that are no near copies all stay. Of
    equal rows one stays. Columns are those of ``docs``, whatever their names; an empty table gives none.
    """
    one, two = row_keys(docs)
    marked = settle(fingerprints(docs, length, told=(one, two)).toDF("doc_id", "fp", "one", "two"), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "one", "two")
    first = settle(marked.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    grouped = components(links(first.select("fp"), distance)).withColumnRenamed("node", "fp")
    named = first.join(grouped, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    kept = settle(named.groupBy("component").agg(F.min("first").alias("first")).select("first.one", "first.two"), "kept")
    # How many equal rows each kept one stands for: one in general.
    count = marked.join(kept, ["one", "two"]).groupBy("one", "two").agg(F.count(F.lit(1)).alias("count"))
    key, other, copies = apart(docs, "one", "two", "count")
    count = settle(count, "counts").toDF(key, other, copies)
    rows = docs.withColumns({key: one, other: two}).join(count, [key, other])
    alone = rows.where(F.col(copies) == 1)
    repeated = rows.where(F.col(copies) > 1).dropDuplicates([key, other])
    return alone.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
