"""Near copies among vectors: int8 tile products with error bounds, full precision where they can't decide.

A unit vector u is stored as u = s * q + e with q in int8. For two of them
|u.v - s_u s_v q_u.q_v| <= |s_u q_u| |e_v| + |e_u| |s_v q_v| + |e_u| |e_v|, so a pair whose integer
product stays below the threshold by more than that cannot be linked. All other pairs are computed
again in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from priceloom.llm.graph import components
from priceloom.session import settle

#: Vectors of one label are compared in tiles of about so many by as many.
TILE = 4096
#: Rows of a tile at a time, and pairs recomputed at a time.
ROWS, PAIRS = 256, 65_536
#: Room for the rounding of double and float sums in the bound.
SLACK = 1e-6


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as int8 codes, their scales, the norms of what the codes stand for, and of the errors."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    held = codes * scale[:, None]
    return codes, scale, np.linalg.norm(held, axis=1), np.linalg.norm(unit - held, axis=1)


def tile_links(ids: np.ndarray, vectors: np.ndarray, left: np.ndarray, right: np.ndarray, least: float):
    """Links of one tile: how many each vector has there, and a label that linked vectors share.

    ``left`` and ``right`` index the two sides; if they are the same, each pair counts once.
    """
    codes, scale, held, error = quantised(vectors)
    norms = np.linalg.norm(vectors, axis=1)
    # Integer products of int8 codes are exact in float32: 127 * 127 * dimensions < 2 ** 24.
    wide = np.float32 if vectors.shape[1] <= 1000 else np.float64
    column = codes[right].astype(wide)
    same = left is right
    count = np.zeros(len(ids), np.int64)
    label = np.arange(len(ids))
    for start in range(0, len(left), ROWS):
        rows = left[start : start + ROWS]
        product = codes[rows].astype(wide) @ column.T
        about = product * scale[rows][:, None] * scale[right][None, :]
        bound = held[rows][:, None] * error[right][None, :] + error[rows][:, None] * (held[right] + error[right])[None, :]
        possible = about + bound >= least - SLACK
        if same:
            possible &= np.arange(start, start + len(rows))[:, None] < np.arange(len(right))[None, :]
        i, j = np.nonzero(possible)
        for at in range(0, len(i), PAIRS):
            a, b = rows[i[at : at + PAIRS]], right[j[at : at + PAIRS]]
            cosine = np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norms[a] * norms[b])
            linked = cosine >= least
            a, b = a[linked], b[linked]
            count += np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
            label = _joined(label, a, b)
    return count, label


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        least = np.minimum(la, lb)
        np.minimum.at(label, la, least)
        np.minimum.at(label, lb, least)
        while not (label == label[label]).all():
            label = label[label]


def near_vectors(
    rows: DataFrame, least: float = 0.98, id: str = "vec_id", vector: str = "embedding", label: str = "label", tile: int = TILE
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): vectors of equal label linked by a cosine of at least ``least``.

    n_links counts the other vectors linked directly, component_id is the smallest id reachable. Vectors
    that are null, empty, zero or hold a null or non-finite component, and vectors without a label, have
    no links and are components of their own; so are vectors of different length among each other.
    Repeated ids are one vector, the one that sorts first. An empty table gives none.

    A label with many rows is cut into blocks by hash of the id, and each pair of blocks is a tile: no
    label fills a task. A tile returns counts and a forest of its links, never its pairs.
    """
    whole = rows.select(
        F.col(id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    whole = whole.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.*")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    whole = settle(whole, "vectors")
    good = whole.where(usable).withColumn("size", F.size("v"))
    blocks = settle(
        good.groupBy("label", "size").agg(F.ceil(F.count("*") / F.lit(float(tile))).cast("int").alias("blocks")), "blocks"
    )
    dealt = good.join(blocks, ["label", "size"]).withColumn("mine", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "size", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") == F.least("mine", "other")).alias("first"), "vec_id", "v",
    )

    def run(found: pa.Table) -> pa.Table:
        ids = found.column("vec_id").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        flat = pc.list_flatten(found.column("v")).to_numpy()
        vectors = flat.reshape(len(ids), -1)[order]
        # Components below the smallest normal numbers would vanish in squares: cosines don't change with scale.
        vectors = vectors / np.abs(vectors).max(axis=1)[:, None]
        if found.column("i")[0].equals(found.column("j")[0]):
            left = right = np.arange(len(ids))
        else:
            first = found.column("first").to_numpy(zero_copy_only=False)[order]
            left, right = np.nonzero(first)[0], np.nonzero(~first)[0]
        count, joined = tile_links(ids, vectors, left, right, least)
        told = np.nonzero(count)[0]
        return pa.table({"vec_id": ids[told], "n": count[told], "to": ids[joined[told]]})

    found = settle(
        dealt.groupBy("label", "size", "i", "j").applyInArrow(run, "vec_id long, n long, to long"), "tile-links"
    )
    linked = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    grouped = components(found.select(F.col("vec_id").alias("a"), F.col("to").alias("b")))
    out = whole.select("vec_id").join(linked, "vec_id", "left").join(
        grouped.withColumnRenamed("node", "vec_id"), "vec_id", "left"
    )
    own = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"),
    )
