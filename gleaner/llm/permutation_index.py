"""Approximate nearest neighbours by a permutation index (operator 9).

A vector is represented by its nearest pivots in order.  Each shard tile posts its vectors in one inverted list per
pivot, with the pivot's rank.  For two vectors with `prefix` pivots each, a pivot missing from one of them counting as
rank `prefix`, the footrule distance is a constant less twice the sum of (prefix - larger rank) over their shared
pivots, so a query adds that up along the lists of its own pivots.  The nearest part of every shard is reranked by the
exact inner product.

Largest inner product is made nearest neighbour by one more component, sqrt(largest norm^2 - norm^2), on indexed
vectors and 0 on queries; for vectors of one length it is 0 throughout.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.vectors import QUERY_ROWS, SHARD_ROWS, best_of, cells, matrix_of, merged, tiles, usable

#: Pivots (the bounded sample the index is fitted on: this many rows, those of the smallest hashes), the pivots that
#: stand for a vector, and the part of each shard that is reranked.
PIVOTS, PREFIX, RERANKED = 512, 64, 0.25


def nearest_pivots(closeness: np.ndarray, prefix: int) -> np.ndarray:
    """The `prefix` closest pivots of each row in order, ties to the smaller pivot number."""
    order = np.argsort(-closeness, axis=1, kind="stable")
    return order[:, :prefix].astype(np.int32)


def postings(near: np.ndarray, pivots: int) -> dict[str, np.ndarray]:
    """Inverted lists of a tile: rows and ranks ordered by pivot, and where each pivot's list starts."""
    flat = near.ravel()
    order = np.argsort(flat, kind="stable")
    width = near.shape[1]
    return {
        "rows": (order // width).astype("<i4"), "ranks": (order % width).astype("<i2"),
        "starts": np.searchsorted(flat[order], np.arange(pivots + 1)).astype("<i4")}


def shared_ranks(near: np.ndarray, rows: np.ndarray, ranks: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Half of what shared pivots take off the footrule distance, for each query row and each row of the tile."""
    prefix = near.shape[1]
    total = np.zeros((len(near), size), np.int32)
    by_pivot = np.argsort(near.ravel(), kind="stable")
    sorted_pivots = near.ravel()[by_pivot]
    cuts = np.flatnonzero(np.diff(sorted_pivots, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(by_pivot)]):
        pivot = sorted_pivots[a]
        asked, rank = by_pivot[a:b] // prefix, by_pivot[a:b] % prefix
        listed, listed_rank = (x[starts[pivot]:starts[pivot + 1]] for x in (rows, ranks))
        if len(listed):
            total[np.ix_(asked, listed)] += prefix - np.maximum.outer(rank, listed_rank)
    return total


def search(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           pivots: int = PIVOTS, prefix: int = PREFIX, reranked: float = RERANKED, least: int = 0) -> DataFrame:
    """Each query row's k nearest found, by inner product in double precision: query_id, rank, vec_id, score.

    Every row for which `queries` holds is a query; candidates are the rows with another id.  All rows are indexed.
    Ties go to the smaller id; repeated candidate rows count each, repeated query rows return a list each.  Null,
    empty, zero or non-finite vectors and null ids take no part; vectors of different lengths raise an error.  An empty
    table gives an empty result.  Of each shard at least k + 1 (and `least`) rows are reranked, and rows at the same footrule distance as
    the last of them.
    """
    fine = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col), zero=False))
    rows = fine.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                       queries.alias("is_query"))
    # fixed size: at most `pivots` vectors and one number come to the driver
    chosen = [r.v for r in rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(pivots).collect()]
    norm = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 0.0
    centres = np.array(chosen, np.float64) if chosen else np.zeros((0, 1))

    def lifted(matrix: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, norm - np.einsum("ij,ij->i", matrix, matrix)))[:, None]

    centre_lift = lifted(centres)
    prefix = min(prefix, max(1, len(centres)))

    def index(matrix: np.ndarray) -> dict[str, np.ndarray]:
        near = nearest_pivots(matrix @ centres.T + lifted(matrix) @ centre_lift.T, prefix)
        return postings(near, len(centres))

    shards, n_shards = tiles(rows, SHARD_ROWS, index, ", rows binary, ranks binary, starts binary")
    asked, n_asked = tiles(rows.where("is_query"), QUERY_ROWS)

    def one(q: pd.Series, s: pd.Series) -> pd.DataFrame:
        a, b = matrix_of(q), matrix_of(s)
        own, ids = np.frombuffer(q["ids"], "<i8"), np.frombuffer(s["ids"], "<i8")
        lists = [np.frombuffer(s[c], t) for c, t in (("rows", "<i4"), ("ranks", "<i2"), ("starts", "<i4"))]
        near = nearest_pivots(a @ centres.T, prefix)
        keep = min(len(b), max(least, k + 1, math.ceil(reranked * len(b))))
        parts = []
        for at in range(0, len(a), 256):
            shared = shared_ranks(near[at:at + 256], *lists, len(b))
            floor = np.partition(shared, len(b) - keep, axis=1)[:, len(b) - keep]
            candidate = shared >= floor[:, None]
            candidate &= own[at:at + 256, None] != ids[None, :]
            for i in range(len(shared)):
                cols = np.flatnonzero(candidate[i])
                if len(cols):
                    _, c, v = best_of((b[cols] @ a[at + i])[None, :], ids[cols], k)
                    parts.append(pd.DataFrame({"q_row": at + i, "vec_id": ids[cols][c], "score": v}))
        return pd.concat(parts) if parts else pd.DataFrame(
            {"q_row": np.zeros(0, int), "vec_id": np.zeros(0, int), "score": np.zeros(0)})

    return merged(cells(asked, n_asked, shards, n_shards, one, "double"), n_shards, k)
