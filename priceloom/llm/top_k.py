"""Exact top-k by inner product: vectors by falling norm, partial sums in the rotated space, residual bounds.

The vectors are rotated by the singular vectors of the whole table, which puts most of a product into
its first components. Candidates are taken by falling norm in blocks. A query skips a block if
norm times norm cannot reach its k-th best score, and a candidate if the partial sum plus the product of the
remaining norms (Cauchy-Schwarz) cannot. What is left is scored exactly, in integers.

The few vectors with components that make 64-bit products unsafe are scored beside this, in whole numbers of
any size.
"""

from __future__ import annotations

import heapq
import math
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from priceloom.session import settle

#: Candidates in a block. The blocks' largest norms go to every task: 8 bytes for so many vectors.
BLOCK = 8192
#: Queries in a tile, and candidates looked at together.
QUERIES, STEP = 4096, 512
#: Components up to here have sums of products that a long holds; vectors with larger ones are scored in Python.
LARGEST = 2**26


def _within(v: Column, most: float) -> Column:
    """Whether all components of a vector are there and at most ``most`` in magnitude."""
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= most)), F.lit(False))


def _rows(rows: DataFrame, scale: float, id: str, vector: str) -> DataFrame:
    """(item, vec_id, x array<double>, large) of the vectors that take part, each row with a number of its own."""
    x = F.col(vector).cast("array<double>")
    sound = rows.where(_within(x, float(np.finfo(float).max)) & F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("vec_id"), x.alias("x"), (~_within(x, LARGEST / scale)).alias("large")
    )
    return settle(sound.withColumn("item", F.monotonically_increasing_id()), "vectors")


def _integers(sound: DataFrame, scale: float) -> DataFrame:
    """(item, vec_id, v array<long>, norm) of the vectors whose products are safe."""
    whole = sound.where("NOT large").select(
        "item", "vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v")
    )
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda sum, x: sum + x.cast("double") * x.cast("double")))
    return whole.withColumn("norm", norm)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of equal length; shorter vectors are as if continued by zeros."""
    lists = column.combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of the table, largest first, from its width x width products."""

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(pa.chunked_array([batch.column(0)]), width).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["cell", "sum"])

    cells = vectors.select("v").mapInArrow(run, "cell long, sum double").groupBy("cell").sum("sum").collect()
    gram = np.zeros(width * width)
    for cell, value in cells:
        gram[cell] = value
    _, basis = np.linalg.eigh(gram.reshape(width, width))
    return np.ascontiguousarray(basis[:, ::-1])


def search(
    query: np.ndarray, query_ids: np.ndarray, known: np.ndarray, rows: np.ndarray, ids: np.ndarray, basis: np.ndarray, k: int, head: int
):
    """(query index, id, score) of candidates that may be among a query's ``k`` best, given a ``known`` k-th score.

    Candidates must come by falling norm.
    """
    width = query.shape[1]
    turned_q, turned_c = query @ basis, rows @ basis
    norm_q, norm_c = np.linalg.norm(query, axis=1), np.linalg.norm(rows, axis=1)
    rest_q, rest_c = np.linalg.norm(turned_q[:, head:], axis=1), np.linalg.norm(turned_c[:, head:], axis=1)
    slack = 1e-9 * width
    known = known.astype(np.float64).copy()
    best = [np.zeros(0, np.int64)] * 3
    for start in range(0, len(rows), STEP):
        part = slice(start, start + STEP)
        reach = norm_q * norm_c[part].max(initial=0) * (1 + slack)
        asking = np.nonzero(reach >= known)[0]
        if not len(asking):
            break
        bound = turned_q[asking, :head] @ turned_c[part, :head].T + rest_q[asking][:, None] * rest_c[part][None, :]
        bound += slack * norm_q[asking][:, None] * norm_c[part][None, :] + 1e-6
        i, j = np.nonzero(bound >= known[asking][:, None])
        i, j = asking[i], j + start
        other = query_ids[i] != ids[j]
        i, j = i[other], j[other]
        scores = np.concatenate(
            [np.einsum("ij,ij->i", query[i[s : s + 65_536]], rows[j[s : s + 65_536]]) for s in range(0, len(i), 65_536)]
            or [np.zeros(0, np.int64)]
        )
        i, found, scores = (np.concatenate(x) for x in zip(best, (i, ids[j], scores), strict=True))
        order = np.lexsort((found, -scores, i))
        i, found, scores = i[order], found[order], scores[order]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        keep = nth < k
        best = [i[keep], found[keep], scores[keep]]
        last = nth == k - 1
        known[i[last]] = np.maximum(known[i[last]], scores[last])
    return best


def _whole(x: float, scale: float) -> int:
    product = x * scale
    return math.floor(product if math.isfinite(product) else Fraction(x) * Fraction(scale))


#: Beyond any long; what is cut off there only has to be told apart from scores that fit.
_TOO_LARGE = 10**37


def _beside(sound: DataFrame, queries, k: int, scale: float) -> DataFrame | None:
    """(item, query_id, vec_id, score decimal) of products with a vector that is not safe; ``None`` without any.

    Blocks of queries against blocks of candidates, in Python's integers; each tile keeps a query's ``k`` best.
    """
    count, n = sound.agg(F.count_if("large"), F.count("*")).first()
    if not count:
        return None

    def run(table: pa.Table) -> pa.Table:
        found = {name: [] for name in ("item", "query_id", "vec_id", "score")}
        held = [(r["asks"], r["item"], r["vec_id"], r["large"], [_whole(x, scale) for x in r["x"]]) for r in table.to_pylist()]
        theirs = [h for h in held if not h[0]]
        for _, item, own, mine_large, mine in (h for h in held if h[0]):
            scores = (
                (sum(a * b for a, b in zip(mine, other, strict=False)), -other_id)
                for _, _, other_id, other_large, other in theirs
                if other_id != own and (mine_large or other_large)
            )
            for score, other_id in heapq.nlargest(k, scores):
                for name, value in (("item", item), ("query_id", own), ("vec_id", -other_id)):
                    found[name].append(value)
                found["score"].append(Decimal(max(-_TOO_LARGE, min(_TOO_LARGE, score))))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.decimal128(38, 0))
        return pa.table({name: pa.array(c, kind) for (name, c), kind in zip(found.items(), kinds, strict=True)})

    few, safe = sound.where("large"), sound.where("NOT large")
    few_blocks, all_blocks = max(1, -(-count // 512)), max(1, -(-n // 512))
    block = lambda blocks: F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("long")
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    told = ["item", "vec_id", "large", "x"]

    def met(asking: DataFrame, asking_blocks: int, other: DataFrame, other_blocks: int, side: int) -> DataFrame:
        """Every block of queries beside every block of candidates."""
        mine = asking.where(queries(F.col("vec_id"))).withColumns({"i": block(asking_blocks), "asks": F.lit(True)})
        theirs = other.withColumns({"j": block(other_blocks), "asks": F.lit(False)})
        mine = mine.select(F.lit(side).alias("side"), "i", every(other_blocks).alias("j"), "asks", *told)
        return mine.unionAll(theirs.select(F.lit(side), every(asking_blocks).alias("i"), "j", "asks", *told))

    tiles = met(few, few_blocks, sound, all_blocks, 0).unionAll(met(safe, all_blocks, few, few_blocks, 1))
    result = "item long, query_id long, vec_id long, score decimal(38,0)"
    return tiles.groupBy("side", "i", "j").applyInArrow(run, result)


def top_k(
    rows: DataFrame, queries, k: int = 5, scale: float = 256.0, id: str = "vec_id", vector: str = "embedding", head: int = 16
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest inner products of floor(scale * x) vectors.

    ``queries`` is a condition on vec_id; candidates are all rows but the query's own id. Ties go to the
    smaller vec_id. Vectors that are null or hold null or non-finite components take no part, nor do rows with a
    null id; all others do, and a score among the ``k`` best that no long holds stops the job. Shorter vectors
    count as continued by zeros; empty vectors score 0. Repeated rows are candidates and queries of their own.
    """
    sound = _rows(rows, scale, id, vector)
    whole = _integers(sound, scale)
    n, width = whole.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK))
    dealt = whole.repartitionByRange(blocks, F.desc("norm"), "vec_id").withColumn("block", F.spark_partition_id())
    dealt = settle(dealt, "blocks")
    found = dealt.groupBy("block").agg(F.max("norm").alias("most"), F.count("*").alias("n")).orderBy("block").collect()
    basis = _rotation(dealt, max(width, 1))
    asked = dealt.where(queries(F.col("vec_id"))).select("item", "vec_id", "v", "norm")
    count = asked.count()
    # Large tiles send fewer vectors; with few queries, smaller ones keep all cores busy.
    groups = max(1, -(-count // QUERIES), min(rows.sparkSession.sparkContext.defaultParallelism, -(-count // 256)))
    asked = settle(asked.withColumn("grp", F.pmod(F.xxhash64("item"), F.lit(groups))), "queries")

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("item").is_valid()
        mine, theirs = table.filter(asks), table.filter(pc.invert(asks))
        theirs = theirs.sort_by([("norm", "descending"), ("vec_id", "ascending")])
        query = _matrix(mine.column("v"), max(width, 1))
        ids = theirs.column("vec_id").to_numpy()
        i, ids, scores = search(
            query, mine.column("vec_id").to_numpy(), mine.column("known").to_numpy(),
            _matrix(theirs.column("v"), max(width, 1)), ids, basis, k, min(head, max(width, 1)),
        )
        items, owners = mine.column("item").to_numpy(), mine.column("vec_id").to_numpy()
        return pa.table({"item": items[i], "query_id": owners[i], "vec_id": ids, "score": scores})

    result = "item long, query_id long, vec_id long, score long"

    def tiles(asking: DataFrame, which: DataFrame) -> DataFrame:
        """Queries (with grp, block and the known k-th score) against the blocks they ask (with grp)."""
        theirs = which.select(
            "grp", "block", "vec_id", "v", "norm", F.lit(None).cast("long").alias("item"), F.lit(None).cast("double").alias("known")
        )
        mine = asking.select("grp", "block", "vec_id", "v", "norm", "item", "known")
        return mine.unionAll(theirs).groupBy("grp", "block").applyInArrow(run, result)

    low = float("-inf")
    head_block = found[0]["block"] if found else 0
    shown = dealt.where(F.col("block") == head_block).withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    first = settle(tiles(asked.withColumns({"block": F.lit(head_block), "known": F.lit(low)}), shown), "head")
    kth = first.groupBy("item").agg(F.min("score").cast("double").alias("kth"), F.count("*").alias("got"))
    asked = asked.join(kth, "item", "left").withColumn(
        "known", F.when(F.col("got") >= k, F.col("kth")).otherwise(F.lit(low))
    )
    later = found[1:]
    if later:
        # Norms fall from block to block, so a query asks a run of them: as long as norm times norm may reach.
        most = np.array([r["most"] for r in later])
        number = np.array([r["block"] for r in later], np.int32)

        def reached(batches):
            for batch in batches:
                norm, known = (batch.column(n).to_numpy(zero_copy_only=False) for n in (3, 5))
                with np.errstate(divide="ignore", invalid="ignore"):
                    least = np.where(norm > 0, known / (norm * (1 + 1e-9)), np.where(known <= 0, -np.inf, np.inf))
                asks = np.searchsorted(-most, -least, side="right")
                ends = np.concatenate([[0], np.cumsum(asks)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.concatenate([number[:m] for m in asks] or [number[:0]]))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "blocks"])

        told = asked.select("item", "vec_id", "v", "norm", "grp", "known")
        asks = told.mapInArrow(reached, "item long, vec_id long, v array<long>, norm double, grp long, known double, blocks array<int>")
        asking = settle(asks.withColumn("block", F.explode("blocks")).drop("blocks"), "asking")
        met = asking.select("grp", "block").distinct()
        first = first.unionAll(tiles(asking, dealt.join(met, "block")))
    beside = _beside(sound, queries, k, scale)
    if beside is not None:
        first = first.withColumn("score", F.col("score").cast("decimal(38,0)")).unionByName(beside)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "vec_id")
    ranked = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    if beside is not None:
        fits = F.col("score").between(F.lit(-(2**63)).cast("decimal(38,0)"), F.lit(2**63 - 1).cast("decimal(38,0)"))
        message = F.concat(F.lit("score beyond a long: query "), F.col("query_id"), F.lit(", vector "), F.col("vec_id"))
        ranked = ranked.withColumn("score", F.when(fits, F.col("score").cast("long")).otherwise(F.raise_error(message).cast("long")))
    return ranked.select("query_id", "rank", "vec_id", "score")
