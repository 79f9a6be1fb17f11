import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from citylake.llm.topk import block_topk, scaled, top_k, top_k_of_embeddings


def slow(rows, k=10, every=100):
    vectors = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vectors.append((i, [math.floor(1024 * float(np.float32(c))) for c in v]))
    out = []
    for at, (i, q) in enumerate(vectors):
        if i % every == 0:
            others = [v for k, v in enumerate(vectors) if k != at]
            scores = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in others)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize(("n", "width", "spread"), [(700, 16, 400), (300, 4, 3), (60, 8, 1), (9, 3, 50), (1, 2, 5)])
def test_block_search_is_exact(n, width, spread):
    rng = np.random.default_rng(n)
    x = rng.integers(-spread, spread + 1, (n, width))
    ids = rng.permutation(n).astype(np.int64)
    q = np.vstack((x[:5], np.zeros((1, width), np.int64)))
    query_ids = np.concatenate((ids[:5], [-1]))
    found = {c: [(-int(s), int(ids[w])) for w, s in zip(who, scores)] for c, who, scores in block_topk(ids, ids, x, query_ids, q, 10, 4)}
    for c in range(len(q)):
        want = sorted((-int(s), int(i)) for s, i in zip(x @ q[c], ids) if i != query_ids[c])[:10]
        assert found[c] == want


def test_long_products_stay_exact():
    x = np.array([[1 << 30, 3], [1 << 30, 4], [(1 << 30) - 1, 9]])
    (_, who, scores), = block_topk(np.arange(3), np.arange(3), x, np.array([-1]), np.array([[1 << 30, 1]]), 2)
    assert scores.tolist() == [(1 << 60) + 4, (1 << 60) + 3] and who.tolist() == [1, 0]


def test_awkward_vectors(spark):
    rows = [
        (0, [0.5, -0.25]), (1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, None), (3, [None, 1.0]), (4, [math.nan, 1.0]),
        (5, [math.inf, 1.0]), (None, [1.0, 1.0]), (6, [0.1]), (7, []), (8, [-0.0001, 0.0]), (100, [1.0, 2.0, 3.0]),
        (200, [0.5, 0.5]), (200, [0.25, 0.5]),
    ]
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], "vec_id long, embedding array<float>, score int, block int")
    got = top_k_of_embeddings(df, F.col("vec_id") % 100 == 0, 3)
    pad = [(i, None if v is None else v + [0.0] * (3 - len(v))) for i, v in rows]
    assert sorted(tuple(r) for r in got.collect()) == slow(pad, 3)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k_of_embeddings(df, F.col("vec_id") % 100 == 0).collect() == []


def test_grid_of_small_tiles_and_long_lists(spark):
    rng = np.random.default_rng(8)
    rows = [(i // 2 if i < 40 else i, [float(np.float32(c)) for c in rng.normal(size=40)]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    keyed = df.select(F.monotonically_increasing_id().alias("key"), "vec_id", scaled(F.col("embedding")).alias("x"))
    got = top_k(keyed, keyed.filter("vec_id % 5 = 0"), 10, block=128, tile=7)
    assert sorted(tuple(r) for r in got.collect()) == slow(rows, every=5)
