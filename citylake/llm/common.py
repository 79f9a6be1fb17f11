"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.session import remove_dir, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths staged since the outermost open `finished` call began; None while there is none.
_scratch: list[str] | None = None


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written once to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    if _scratch is not None:
        _scratch.append(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_path = path
    return back


def finished(build: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """The result of `build` as a staged table; what was staged to get there is removed.

    After a failure everything stays, for a look or a restart."""
    global _scratch
    outer, _scratch = _scratch, []
    try:
        result = build()
        inner, _scratch = _scratch, outer
        out = staged(result, purpose)
    finally:
        _scratch = outer
    for path in inner:
        remove_dir(result.sparkSession, path)
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table that no later step reads."""
    remove_dir(df.sparkSession, df.staged_path)


def runs_of(column: pa.Array, budget: int) -> Iterator[tuple[int, int]]:
    """(offset, length) runs of at most about `budget` bytes, or one longer text."""
    if not len(column):
        return
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    marks = np.cumsum(sizes, dtype=np.int64) // budget
    edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(column)]
    for start, stop in zip(edges, edges[1:], strict=False):
        yield start, stop - start


def text_slices(column: pa.Array, budget: int = 8 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """(offset, texts) of those runs."""
    for start, size in runs_of(column, budget):
        yield start, column.slice(start, size).to_pylist()


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs flat[starts[i] : starts[i] + lengths[i]], end to end."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of `edges` (a, b), as (node, root), root the smallest node.

    Large-star and small-star rounds (each node sends its larger, then its smaller
    neighbours to the smallest one) until the edges are stars; the number of rounds
    grows with the logarithm of the longest path. Groups are only reduced to a
    minimum, so a hub costs one row per task. Nodes without an edge are left out.
    A round never has more rows than the one before. It writes two tables to the shared
    folder, so a lost executor costs one round; the smallest and largest neighbours,
    which it needs first, also tell whether the edges are stars.
    """
    now = staged(_directed(edges), "edges")
    for _ in range(max_rounds):
        near = _neighbours(now)
        if not near.agg(F.max((F.col("low") < F.col("u")) & (F.col("low") < F.col("high")))).first()[0]:
            break
        before, now = now, staged(_small_star(_large_star(now, near)), "small-star")
        discard(near)
        discard(before)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return near.select(F.col("u").alias("node"), F.least("u", "low").alias("root"))


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, larger end first."""
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _neighbours(edges: DataFrame) -> DataFrame:
    """(u, low, high): the smallest and the largest neighbour of every node."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    return staged(both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high")), "neighbours")


def _large_star(edges: DataFrame, near: DataFrame) -> DataFrame:
    """The larger end of every edge, moved to the smallest of the other end and its neighbours."""
    to = near.select(F.col("u").alias("b"), F.least("u", "low").alias("to"))
    return edges.join(to, "b").select("a", F.col("to").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of every node, and itself, moved to the smallest one."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low)
