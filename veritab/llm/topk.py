"""Exact top-k inner products with bounds from segment statistics, coarse to fine.

Cut a vector into segments of l components with mean m and deviation s. For any two vectors the Euclidean distance is
at least sum l * ((m - m')^2 + (s - s')^2), and with known norms this bounds the inner product from above by
sum l * (m * m' + s * s'). Each level halves the segments; rows whose bound cannot reach the k-th best score so far
are dropped before the next level, and the survivors are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.staging import staged

#: segments of the levels
LEVELS = (4, 16)
QUERY_BLOCK, ROW_BLOCK = 512, 4096
SCALE = 64


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``dim`` and ``q``, the components as floor(64 x); vectors with null or non-finite parts are left out."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & whole & (F.size(x) > 0)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.size(x).alias("dim"),
        F.transform(x, lambda v: F.floor(v * SCALE)).cast("array<long>").alias("q"))


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each row's segments, both times the root of the segment's length."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1]))
    roots = np.sqrt([len(p) for p in parts])
    means = np.stack([x[:, p].mean(1) for p in parts], 1) * roots
    spreads = np.stack([x[:, p].std(1) for p in parts], 1) * roots
    return np.concatenate([means, spreads], 1)


def exact_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products: by floats while these are exact, else by Python integers."""
    reach = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1]
    if reach < 2 ** 53:
        return (queries.astype(float) @ rows.T.astype(float)).astype(np.int64)
    return (queries.astype(object) @ rows.T.astype(object)).astype(np.int64)


def best_in_block(query_ids, queries, row_ids, rows, k: int) -> pd.DataFrame:
    """The k best rows of one block for each query of one block (all, if fewer).

    Level by level, the rows of best bound are scored exactly, which gives each query a score that its k-th best
    reaches at least; what cannot reach it is dropped, and so are rows that no query needs any more.
    """
    qf, rf = queries.astype(float), rows.astype(float)
    slack = 1e-9 * (1 + np.sqrt((qf * qf).sum(1).max() * (rf * rf).sum(1).max()))
    alive, left = row_ids[None, :] != query_ids[:, None], np.arange(len(rows))
    floor = np.full(len(queries), -np.inf)
    for segments in LEVELS:
        bound = segment_statistics(qf, segments) @ segment_statistics(rf[left], segments).T
        bound[~alive] = -np.inf
        if len(left) >= k:
            first = np.argpartition(-bound, k - 1, axis=1)[:, :k]
            near = np.einsum("qd,qnd->qn", qf, rf[left[first]])
            near[~np.take_along_axis(alive, first, 1)] = -np.inf
            floor = np.maximum(floor, near.min(1))
        alive &= bound + slack >= floor[:, None] - slack
        needed = alive.any(0)
        left, alive = left[needed], alive[:, needed]
    scores = exact_scores(queries, rows[left])
    out = {"query_id": [], "vec_id": [], "score": []}
    for i, query in enumerate(query_ids):
        own = np.flatnonzero(alive[i])
        top = own[np.lexsort((row_ids[left[own]], -scores[i, own]))[:k]]
        out["query_id"].append(np.full(len(top), query))
        out["vec_id"].append(row_ids[left[top]])
        out["score"].append(scores[i, top])
    return pd.DataFrame({name: np.concatenate(parts).astype("int64") for name, parts in out.items()})


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's ``k`` highest scores, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``; candidates all rows of the same dimension but those with
    the query's own id. Null, empty and non-finite vectors and null ids take no part; equal rows count once, rows
    of one id with different vectors each for themselves (as queries they share one list); empty input gives no
    rows; other columns are ignored. Blocks of queries meet blocks of rows, so that a task holds one block of each.
    """
    own = staged(quantised(vectors, id_col, vector_col).distinct(), "topk-rows")
    counts = own.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("vec_id") % every == 0).cast("long")).alias("nq"))
    sized = own.join(F.broadcast(counts), "dim") if counts.count() < 1000 else own.join(counts, "dim")
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40))
    sized = sized.withColumns({
        "_rows": F.ceil(F.col("n") / ROW_BLOCK).cast("long"), "_queries": F.ceil(F.col("nq") / QUERY_BLOCK).cast("long"),
    }).where("_queries > 0")
    rows = sized.withColumns({"rb": spread % F.col("_rows"), "qb": F.explode(F.sequence(F.lit(0).cast("long"), F.col("_queries") - 1))})
    asked = sized.where(F.col("vec_id") % every == 0).withColumns({
        "qb": spread % F.col("_queries"), "rb": F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1))})
    cells = rows.select("dim", "qb", "rb", "vec_id", "q", F.lit(0).alias("asks")).unionByName(
        asked.select("dim", "qb", "rb", "vec_id", "q", F.lit(1).alias("asks")))

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows["asks"].to_numpy() == 1
        values, ids = np.stack(rows["q"].to_numpy()), rows["vec_id"].to_numpy()
        if not asks.any() or asks.all():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return best_in_block(ids[asks], values[asks], ids[~asks], values[~asks], k)

    found = cells.groupBy("dim", "qb", "rb").applyInPandas(cell, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
