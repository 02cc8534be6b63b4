"""Exact top-k search by tiled matrix products (operator 2) and a permutation index (operator 9).

Both pack vectors into tiles: one row holds up to a few thousand vectors as one binary matrix.  A stated query set goes
against all rows in cells of one query tile and one shard tile; a cell returns a short list per query, and the lists
are merged in a tree of bounded fan-in.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.shared import settled

#: Rows of a shard tile and of a query tile on average, and lists merged at once.
SHARD_ROWS, QUERY_ROWS, FAN_IN = 8192, 2048, 16


def usable(vector: Column, zero: bool = True) -> Column:
    """Whether a vector is there, not empty, and all its components are finite; without `zero`, not all zero either."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = vector.isNotNull() & (F.size(vector) > 0) & finite
    if not zero:
        good = good & F.exists(x, lambda v: v != 0)
    return F.coalesce(good, F.lit(False))


def tiles(rows: DataFrame, per_tile: int, extra: Callable[[np.ndarray], dict[str, np.ndarray]] | None = None,
          extra_schema: str = "") -> tuple[DataFrame, int]:
    """Rows (id, v array<double>) dealt evenly to tiles: tile, size, ids, matrix and what `extra` makes of the matrix.

    All vectors of a tile must be of one length.  The tiles are written once, so that a lost executor cannot deal
    another set.  The second value is the number of tiles, numbered from 0.
    """
    count = max(1, math.ceil(rows.count() / per_tile))

    def pack(index: int, ids: list[int], parts: list[np.ndarray]) -> pd.DataFrame:
        matrix = np.concatenate(parts)
        more = extra(matrix) if extra else {}
        return pd.DataFrame({
            "tile": [index], "size": [len(ids)], "ids": [np.array(ids, "<i8").tobytes()],
            "matrix": [matrix.astype("<f8").tobytes()], **{k: [v.tobytes()] for k, v in more.items()}})

    def run(batches):
        from pyspark import TaskContext

        ids, parts = [], []
        for batch in batches:
            if len(batch):
                ids.extend(batch["id"].tolist())
                parts.append(np.stack(batch["v"].to_list()))
        if ids:
            yield pack(TaskContext.get().partitionId(), ids, parts)

    schema = "tile int, size int, ids binary, matrix binary" + extra_schema
    return settled(rows.select("id", "v").repartition(count).mapInPandas(run, schema)), count


def matrix_of(row, name: str = "matrix", kind: str = "<f8") -> np.ndarray:
    return np.frombuffer(row[name], kind).reshape(row["size"], -1)


def cells(queries: DataFrame, query_tiles: int, shards: DataFrame, shard_tiles: int,
          search: Callable[[pd.Series, pd.Series], pd.DataFrame], score: str) -> DataFrame:
    """One list per query row and shard tile: (q_tile, q_row, query_id, shard, best array of (score, vec_id)).

    `search` gets a query tile and a shard tile and returns q_row, vec_id and score.  Cells are the grid of both sets
    of tiles: each tile is sent once to every tile of the other side, and a cell holds one of each.
    """
    left = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shard_tiles - 1)))) \
        .withColumnRenamed("tile", "q_tile")
    right = shards.withColumn("q_tile", F.explode(F.sequence(F.lit(0), F.lit(query_tiles - 1)))) \
        .withColumnRenamed("tile", "shard")

    def run(key, ones: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        names = ["q_tile", "q_row", "query_id", "shard", "best"]
        if not len(ones) or not len(others):
            return pd.DataFrame(columns=names)
        q, s = ones.iloc[0], others.iloc[0]
        found = search(q, s)
        if not len(found):
            return pd.DataFrame(columns=names)
        ids = np.frombuffer(q["ids"], "<i8")
        rows, starts = np.unique(found["q_row"].to_numpy(), return_index=True)
        ends = [*starts[1:], len(found)]
        scores, vec = found["score"].to_numpy(), found["vec_id"].to_numpy()
        return pd.DataFrame({
            "q_tile": np.int32(q["q_tile"]), "q_row": rows.astype(np.int32), "query_id": ids[rows],
            "shard": np.int32(s["shard"]),
            "best": [[{"score": scores[i], "vec_id": vec[i]} for i in range(a, b)] for a, b in zip(starts, ends)]})

    return left.groupBy("q_tile", "shard").cogroup(right.groupBy("q_tile", "shard")).applyInPandas(
        run, f"q_tile int, q_row int, query_id long, shard int, best array<struct<score:{score},vec_id:long>>")


def merged(lists: DataFrame, shard_tiles: int, k: int) -> DataFrame:
    """The lists of each query merged in a tree, `FAN_IN` at a time, and given out as query_id, rank, vec_id, score."""
    left = shard_tiles
    order = "(a, b) -> case when a.score > b.score then -1 when a.score < b.score then 1 " \
            "when a.vec_id < b.vec_id then -1 when a.vec_id > b.vec_id then 1 else 0 end"
    while True:
        lists = lists.withColumn("shard", F.expr(f"shard div {FAN_IN}").cast("int")) \
            .groupBy("q_tile", "q_row", "query_id", "shard").agg(F.flatten(F.collect_list("best")).alias("best")) \
            .withColumn("best", F.expr(f"slice(array_sort(best, {order}), 1, {k})"))
        left = math.ceil(left / FAN_IN)
        if left <= 1:
            break
    return lists.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        F.col("hit.score").alias("score"))


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of a score matrix the k largest (-inf: none), ties to the smaller id: row, column, score."""
    width = scores.shape[1]
    keep = min(k, width)
    # everything at or above the k-th largest, so that no tie is lost before ids decide
    floor = np.partition(scores, width - keep, axis=1)[:, width - keep]
    rows, cols = np.nonzero((scores >= floor[:, None]) & (scores > -np.inf))
    order = np.lexsort((ids[cols], -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    first = np.searchsorted(rows, rows, side="left")
    near = np.arange(len(rows)) - first < k
    rows, cols = rows[near], cols[near]
    return rows, cols, scores[rows, cols]


def exact_top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
                vector_col: str = "embedding") -> DataFrame:
    """Each query row's k candidates of the largest integer inner product: query_id, rank, vec_id, score (all long but
    rank, int).

    Components are floor(scale * x).  Every row for which `queries` holds is a query; candidates are the rows with
    another id.  Ties go to the smaller id; repeated candidate rows count each, repeated query rows return a list each.
    A null, empty or non-finite vector and a null id take no part; vectors of different lengths are not comparable and
    raise an error.  An empty table gives an empty result.  Products are exact: in double precision while the largest
    possible sum stays below 2^53, else in 64-bit integers.
    """
    fine = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    rows = fine.select(
        F.col(id_col).cast("long").alias("id"), queries.alias("is_query"),
        F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.floor(x * scale).cast("double")).alias("v"))
    shards, n_shards = tiles(rows, SHARD_ROWS)
    asked, n_asked = tiles(rows.where("is_query"), QUERY_ROWS)

    def search(q: pd.Series, s: pd.Series) -> pd.DataFrame:
        a, b = matrix_of(q), matrix_of(s)
        own, ids = np.frombuffer(q["ids"], "<i8"), np.frombuffer(s["ids"], "<i8")
        largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
        if largest >= 2.0 ** 53:
            a, b = a.astype(np.int64), b.astype(np.int64)
        elif largest < 2.0 ** 24:
            a, b = a.astype(np.float32), b.astype(np.float32)
        parts = []
        for at in range(0, len(a), 256):
            scores = a[at:at + 256] @ b.T
            own_row = own[at:at + 256, None] == ids[None, :]
            if scores.dtype == np.int64:
                scores[own_row] = np.iinfo(np.int64).min
                r, c, v = _best_whole(scores, ids, k)
            else:
                scores[own_row] = -np.inf
                r, c, v = best_of(scores, ids, k)
            parts.append(pd.DataFrame({"q_row": r + at, "vec_id": ids[c], "score": v.astype(np.int64)}))
        return pd.concat(parts)

    return merged(cells(asked, n_asked, shards, n_shards, search, "long"), n_shards, k)


def _best_whole(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`best_of` for 64-bit integers; the smallest integer stands for none."""
    keep = min(k, scores.shape[1])
    floor = np.partition(scores, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep]
    rows, cols = np.nonzero((scores >= floor[:, None]) & (scores > np.iinfo(np.int64).min))
    order = np.lexsort((ids[cols], ~scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    near = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
    return rows[near], cols[near], scores[rows[near], cols[near]]
