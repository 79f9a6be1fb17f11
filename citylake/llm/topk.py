"""Exact top-k by aggregation without random access.

Vectors are dealt into blocks. In a block every dimension is a list sorted by value, read
downwards for queries with a positive weight there and upwards for negative ones, so
contributions never grow along a list. All lists advance together, a stretch at a time.
What has been read of a vector gives its score so far; for what has not, the list's
current value bounds the contribution from above and its last value from below. Once, for
every query, only a few vectors can still reach its k-th best lower bound, reading stops
and their scores are resolved. All queries of a tile advance in one matrix product.

Vectors and queries meet on a grid: a block of vectors goes to every tile of queries once. A
tile holds as many queries as fit TILE_CELLS numbers and is worked off in parts of PART
queries, so vectors are copied once per some ten thousand queries.

Cases. Vectors that are null or hold a null or non-finite component, and rows with a null
id, take no part. Rows that repeat an id are candidates each, and a query row is met by
every row but itself; each of several query rows of one id has its own list. A missing
component counts as zero. Ties go to the smaller id. An empty table gives no rows; with
fewer than k candidates all are returned. Other columns are ignored. Scores are exact
while they fit a long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm.common import staged

SCALE = 1024
BLOCK = 8192
LEAST_BLOCK = 512
TILE_CELLS = 1 << 22
PART = 1024
SURVIVORS = 64
EXACT = float(1 << 53)


def scaled(vector, scale: int = SCALE) -> F.Column:
    """floor(scale * x) of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector) -> F.Column:
    """Not null, every component finite."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def block_topk(
    keys: np.ndarray,
    ids: np.ndarray,
    x: np.ndarray,
    query_keys: np.ndarray,
    q: np.ndarray,
    k: int,
    survivors: int = SURVIVORS,
) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query, positions, scores) of the k best rows of `x` for each row of `q`, without the
    row of the query's own key."""
    n, width = x.shape
    exact = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * width < EXACT
    kind = np.float64 if exact else np.int64
    down = np.argsort(-x, axis=0, kind="stable")
    rank = np.empty((n, width), np.int64)
    np.put_along_axis(rank, down, np.broadcast_to(np.arange(n)[:, None], (n, width)), axis=0)
    sorted_x = np.take_along_axis(x, down, axis=0)
    highest, lowest = sorted_x[0].astype(kind), sorted_x[-1].astype(kind)
    values = x.astype(kind)
    open_queries = np.arange(len(q))
    plus, minus = np.maximum(q, 0).astype(kind), np.minimum(q, 0).astype(kind)
    known = np.zeros((n, len(q)), kind)
    none = np.iinfo(np.int64).min if not exact else -np.inf
    out, depth, step = [], 0, max(1, n // 8)
    while len(open_queries):
        new = min(n, depth + step)
        fresh_down, fresh_up = (rank >= depth) & (rank < new), (rank < n - depth) & (rank >= n - new)
        p, m = plus[open_queries].T, minus[open_queries].T
        known = known + np.where(fresh_down, values, 0) @ p + np.where(fresh_up, values, 0) @ m
        depth = new
        seen_down, seen_up = rank < depth, rank >= n - depth
        front_down, front_up = sorted_x[depth - 1].astype(kind), sorted_x[n - depth].astype(kind)
        unread_down, unread_up = (~seen_down).astype(kind), (~seen_up).astype(kind)
        upper = known + unread_down @ (p * front_down[:, None]) + unread_up @ (m * front_up[:, None])
        lower = known + unread_down @ (p * lowest[:, None]) + unread_up @ (m * highest[:, None])
        own = keys[:, None] == query_keys[open_queries][None, :]
        lower[own] = none
        upper[own] = none
        bar = np.partition(lower, n - k, axis=0)[n - k] if n > k else np.full(lower.shape[1], none)
        able = (upper >= bar) & ~own
        settled = (able.sum(axis=0) <= max(survivors, k)) | (depth == n)
        for c in np.flatnonzero(settled):
            who = np.flatnonzero(able[:, c])
            scores = x[who] @ q[open_queries[c]]  # the few that are left
            best = np.lexsort((ids[who], -scores))[:k]
            out.append((int(open_queries[c]), who[best], scores[best]))
        known, open_queries = known[:, ~settled], open_queries[~settled]
    return out


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    block: int = BLOCK,
    tile: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for `queries` over `vectors`, both (key, vec_id, x) with
    integer vectors; a query meets all vectors but that of its own key.

    Each task holds one block and one tile whatever the number of rows; from a block only
    its k best per query leave.
    """
    spark = vectors.sparkSession
    n_vectors, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(1))).first()
    n_queries = queries.count()
    tile = tile or max(PART, TILE_CELLS // max(width, 1))
    tiles = max(1, -(-n_queries // tile))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n_vectors // block), min(tasks, -(-n_vectors // LEAST_BLOCK)))

    def dealt(rows: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        return rows.select(
            F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other),
            "key",
            "vec_id",
            "x",
        )

    left = dealt(vectors, "block", blocks, "tile", tiles).groupBy("block", "tile")
    right = dealt(queries, "tile", tiles, "block", blocks).groupBy("block", "tile")

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = {"query_key": [], "query_id": [], "vec_id": [], "score": []}
        if len(rows) and len(asked):
            width = max(rows["x"].map(len).max(), asked["x"].map(len).max())
            keys, ids, x = rows["key"].to_numpy(), rows["vec_id"].to_numpy(), matrix(rows["x"], width)
            for at in range(0, len(asked), PART):
                part = asked.iloc[at : at + PART]
                query_keys, query_ids = part["key"].to_numpy(), part["vec_id"].to_numpy()
                for c, who, scores in block_topk(keys, ids, x, query_keys, matrix(part["x"], width), k):
                    columns["query_key"] += [int(query_keys[c])] * len(who)
                    columns["query_id"] += [int(query_ids[c])] * len(who)
                    columns["vec_id"] += ids[who].tolist()
                    columns["score"] += scores.tolist()
        return pd.DataFrame({name: np.array(c, np.int64) for name, c in columns.items()})

    found = left.cogroup(right).applyInPandas(search, "query_key long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_key").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def top_k_of_embeddings(
    embeddings: DataFrame, is_query: F.Column, k: int = 10, scale: int = SCALE
) -> DataFrame:
    """Top k over all rows of (vec_id, embedding) for those with `is_query` (over vec_id)."""
    rows = (
        embeddings.select(F.col("vec_id").cast("long"), F.col("embedding"))
        .filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select(F.monotonically_increasing_id().alias("key"), "vec_id", scaled(F.col("embedding"), scale).alias("x"))
    )
    rows = staged(rows, "topk-vectors")
    return top_k(rows, rows.filter(is_query), k)
