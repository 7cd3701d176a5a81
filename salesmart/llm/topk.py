"""Exact top-k search by inner product with the threshold algorithm.

Items are dealt into blocks by a hash of their id; queries are dealt into blocks
too and meet every item block once, so no task holds more than one block of each.
Inside a pair of blocks, every dimension has a list of the items sorted by that
component. A query reads its lists from the end that its weight prefers, scores
the items it meets in full, and stops when the sum of the weighted components at
the current depth (the best an unseen item can reach) is below its k-th score.
The best k of each block are ranked once more over all blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTIAL = "query_id bigint, query_key bigint, item_id bigint, score bigint"


def integer_vectors(df: DataFrame, id_column: str, vector_column: str, scale: int = 1024) -> DataFrame:
    """``id, vector`` with every component floor(scale * x), x as double.

    Rows with a null id or vector, or with a null or non-finite component, are left out.
    """
    x = F.col(vector_column).cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return df.filter(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & fine).select(
        F.col(id_column).cast("bigint").alias("id"), F.transform(x, lambda v: F.floor(v * scale)).alias("vector")
    )


def matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


class SortedLists:
    """One sorted list of items per dimension, over one block of items."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.order, axis=0)

    def search(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best items other than ``own``; ties go to smaller ids."""
        n = len(self.ids)
        up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
        step = max(4, n // 24) if len(up) + len(down) else n
        seen = np.zeros(n, bool)
        seen[self.ids == own] = True
        ids, scores = np.empty(0, np.int64), np.empty(0)
        for depth in range(0, n, step):
            end = min(depth + step, n)
            if end == n:
                fresh = np.flatnonzero(~seen)
            else:
                met = np.zeros(n, bool)
                met[self.order[depth:end, up]] = True
                met[self.order[n - end : n - depth, down]] = True
                fresh = np.flatnonzero(met & ~seen)
            seen[fresh] = True
            found = self.vectors[fresh] @ query
            if len(scores) >= k:
                good = found >= scores[k - 1]
                fresh, found = fresh[good], found[good]
            ids, scores = np.concatenate([ids, self.ids[fresh]]), np.concatenate([scores, found])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if end < n and len(scores) == k:
                bound = query[up] @ self.values[end, up] + query[down] @ self.values[n - 1 - end, down]
                if scores[k - 1] > bound:  # an equal score could still win by its id
                    break
        return ids, scores


def search_block(k: int):
    def run(items: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(items) and len(queries):
            width = max(map(len, [*items["vector"], *queries["vector"]]))
            lists = SortedLists(items["id"].to_numpy(np.int64), matrix(list(items["vector"]), width))
            asked = matrix(list(queries["vector"]), width)
            if np.abs(lists.vectors).max(initial=0) * np.abs(asked).sum(1).max(initial=0) >= 2**53:
                raise ValueError("inner products beyond 53 bits are not exact")
            for own, key, query in zip(queries["id"], queries["query_key"], asked, strict=True):
                ids, scores = lists.search(query, k, own)
                out.append(pd.DataFrame({"query_id": own, "query_key": key, "item_id": ids, "score": scores.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame(columns=["query_id", "query_key", "item_id", "score"], dtype="int64")

    return run


def exact_top_k(queries: DataFrame, items: DataFrame, k: int = 10, item_block: int = 16384, query_block: int = 2048, least_blocks: int = 16) -> DataFrame:
    """``query_id, rank, item_id, score``: the ``k`` items of highest inner product for each query.

    Both inputs have ``id`` and ``vector`` (integers; the products must fit 53 bits, else the search ends with an error).
    Other columns are not read and may have any names. Vectors without structure cannot be pruned: the bound stays above
    the k-th score until nearly all items are met, and all are scored.
    An item never answers the query of its own id. Shorter vectors count as padded
    with zeros. Ties go to the smaller id. Repeated item rows each take a place;
    repeated query rows are asked once. Empty inputs give no rows.
    """
    blocks = max(least_blocks, -(-items.count() // item_block))
    asked = queries.select("id", "vector").distinct().withColumn("query_key", F.xxhash64("id", "vector"))
    query_blocks = max(1, -(-asked.count() // query_block))
    dealt = asked.withColumn("query_part", F.pmod("query_key", F.lit(query_blocks))).withColumn("item_part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    parts = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    held = items.select("id", "vector", parts.alias("item_part")).withColumn("query_part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).withColumn("query_part", F.col("query_part").cast("bigint"))
    found = held.groupBy("item_part", "query_part").cogroup(dealt.groupBy("item_part", "query_part")).applyInPandas(search_block(k), PARTIAL)
    place = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "item_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "item_id", "score")
