import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from citylake.llm import common
from citylake.llm.simhash import bucket_links, covering_masks, fingerprint, forest, hex_digits, near_duplicates, stars
from tests.llm.helpers import awkward, awkward_rows, clashing, empty


def slow_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    """Smallest index reachable, for a list of fingerprints."""
    a, root = np.array(fps, np.uint64), list(range(len(fps)))
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 2):
            x, y = root[i], root[j]
            root = [min(x, y) if r in (x, y) else r for r in root]
    return root


@pytest.mark.parametrize("text", [r[1] for r in awkward_rows()] + ["A", "a b", "É a B", "a  b\x0bc d"])
def test_fingerprint_is_the_majority_of_shingle_bits(text):
    assert fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize(("n", "radius"), [(64, 1), (64, 2), (28, 2), (20, 3)])
def test_masks_hide_every_difference_within_the_radius(n, radius):
    masks = covering_masks(list(range(n)), radius)
    for bits in itertools.combinations(range(n), radius):
        difference = sum(1 << b for b in bits)
        assert any(not m & difference for m in masks)


def test_second_masking_bounds_a_bucket():
    for mask in covering_masks(list(range(64)), 2):
        free = [b for b in range(64) if not mask >> b & 1]
        for finer in covering_masks(free, 2):
            assert 64 - (mask | finer).bit_count() <= 12


def test_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 1 << 9, 120).astype(np.uint64))
    root = dict(zip(map(int, fps), slow_components(fps)))
    for a, b in forest(fps.view(np.int64), 2):
        assert (a ^ b).bit_count() <= 2 and root[a] == root[b]
    assert len(forest(fps.view(np.int64), 2)) == len(fps) - len(set(root.values()))


def test_stars_join_what_the_forest_joins():
    rng = np.random.default_rng(4)
    fps = np.unique(rng.integers(0, 1 << 9, 120).astype(np.uint64) | np.uint64(1 << 63) * rng.integers(0, 2, 120).astype(np.uint64))
    links = stars(fps.view(np.int64), 2)
    roots, least = slow_components(fps), {}
    for f, r in zip(fps.view(np.int64).tolist(), roots):
        least[r] = min(f, least.get(r, f))
    want = {int(f): least[r] % (1 << 64) for f, r in zip(fps, roots)}
    assert {a: b for a, b in links} == {a: b for a, b in want.items() if a != b}


def slow_reach(edges):
    root = {x: x for e in edges for x in e}
    for a, b in edges:
        low, high = sorted((root[a], root[b]))
        root = {x: low if r == high else r for x, r in root.items()}
    return root


def test_components_of_a_path_a_hub_and_a_cycle_by_few_tables(spark, monkeypatch):
    """Each written table is a wait for the slowest task: two a round, and none to see the end."""
    made, write = [], common.staged
    monkeypatch.setattr(common, "staged", lambda df, purpose: made.append(purpose) or write(df, purpose))
    rng, names = random.Random(1), random.Random(2).sample(range(-10_000, 10_000), 400)
    path, hub, ring = names[:100], names[100:250], names[250:]
    edges = list(zip(path, path[1:])) + [(hub[0], x) for x in hub[1:]] + list(zip(ring, ring[1:] + ring[:1]))
    edges += [(b, a) for a, b in edges[::3]] + [(5, 5)]
    rng.shuffle(edges)
    out = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in out} == slow_reach([e for e in edges if e != (5, 5)]) and len(out) == 400
    assert len(made) <= 14
    made.clear()
    out = common.components(spark.createDataFrame([(x, 0) for x in range(1, 50)], "a long, b long")).collect()
    assert len(out) == 50 and len(made) == 2
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("direct", [2, 512])
def test_links_keep_components_with_and_without_second_masking(spark, direct):
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 1 << 62))
    fps = {base ^ (1 << int(a)) ^ (1 << int(b)) ^ (int(c) << 40) for a, b, c in rng.integers(0, 9, (150, 3))}
    fps = sorted(fps | {int(x) for x in rng.integers(0, 1 << 62, 100)})
    links = bucket_links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2, direct).collect()
    want, root = slow_components(fps), {f: f for f in fps}
    for a, b in links:
        assert (a ^ b).bit_count() <= 2
        x, y = root[a], root[b]
        root = {f: min(x, y) if r in (x, y) else r for f, r in root.items()}
    got = [fps.index(root[f]) for f in fps]
    assert got == want


@pytest.mark.parametrize("rows", [awkward, clashing])
def test_awkward_rows(spark, rows):
    out = near_duplicates(rows(spark)).select("doc_id", hex_digits("fp").alias("f"), "component_id").collect()
    docs = awkward_rows()
    fps = [slow_fingerprint(r[1]) for r in docs]
    roots = slow_components(fps)
    least = {}
    for (doc, *_), root in zip(docs, roots):
        if doc is not None:
            least[root] = min(doc, least.get(root, doc))
    want = [(d[0], f"{f:016x}", least.get(r)) for d, f, r in zip(docs, fps, roots)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).collect() == []


def test_query_against_brute_force(spark, sf_dir):
    from citylake.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    fps = [slow_fingerprint(d["text"]) for d in docs]
    roots = slow_components(fps)
    want = {d["doc_id"]: (f"{f:016x}", docs[r]["doc_id"]) for d, f, r in zip(docs, fps, roots)}
    out = QUERIES["op5_simhash_covering_lsh"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in out} == want
    assert len(out) == len(docs)
