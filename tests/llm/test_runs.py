import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from citylake.llm import queries, runs
from tests.llm.helpers import awkward, clashing, empty


def slow_runs(words, least=12):
    """Every maximal stretch of every period; the smallest period of a stretch counts."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def slow_planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def slow_digest(doc_id, text):
    words = slow_planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = slow_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id,
        len(found),
        *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        digest("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def made_up(rng):
    n, k = rng.choice([0, 1, 5, 11, 12, 13, 30, 100, 300, 700]), rng.choice([1, 2, 3, 5, 50])
    words = [f"w{rng.randrange(k)}" for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n > 4:
            a = rng.randrange(n)
            p, e = 1 + rng.randrange(max(1, (n - a) // 2)), rng.randrange(a, n)
            words[a : e + 1] = [words[a + (i - a) % p] for i in range(a, e + 1)]
    return words


@pytest.mark.parametrize("seed", range(25))
def test_runs_as_brute_force(seed):
    rng = random.Random(seed)
    texts = [made_up(rng) for _ in range(8)]
    texts += texts[:2]
    _, found = runs.runs_of_texts([" ".join(t) for t in texts])
    for words, got in zip(texts, found, strict=True):
        assert [tuple(r) for r in got.tolist()] == slow_runs(words)


@pytest.mark.parametrize("size", [2, 8, 64])
def test_mismatches_are_exact_sums(size):
    rng = np.random.default_rng(size)
    b = size // 2
    blocks = rng.integers(0, 1000, (3, b), np.uint64)
    windows = rng.integers(0, 1000, (3, 3 * b - 1), np.uint64)
    want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(blocks[m], windows[m, d : d + b])) for d in range(2 * b)] for m in range(3)]
    assert runs.mismatches(blocks, windows).tolist() == want
    assert runs.ntt(runs.ntt(blocks), inverse=True).tolist() == blocks.tolist()


def test_long_periodic_texts_stay_fast():
    start = time.monotonic()
    for period in (1, 7, 9_973):
        _, found = runs.runs_of_texts([" ".join(f"w{i % period}" for i in range(200_000))])
        assert found[0].tolist() == [[0, 200_000, period]]
    assert time.monotonic() - start < 60


def test_query_on_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = [tuple(r) for r in queries.QUERIES["op13_periodic_runs_ntt"](spark, sf_dir).collect()]
    short = {d["doc_id"]: d["text"] for d in docs if len((d["text"] or "").split()) <= 2500}
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    assert sorted(r for r in got if r[0] in short) == sorted(slow_digest(i, t) for i, t in short.items())
    assert sum(r[1] > 0 for r in got) >= len(docs) // 20


@pytest.mark.parametrize("rows", [awkward, clashing, empty])
def test_awkward_rows(spark, rows):
    docs = rows(spark).withColumns({"runs": F.lit(1), "collapsed": F.lit("x"), "start": F.lit(2)})
    found = runs.periodic_runs(docs)
    assert set(found.columns) == set(docs.columns)
    assert {(r["doc_id"], r["text"]) for r in found.collect()} == {(r["doc_id"], r["text"]) for r in docs.collect()}
    for r in found.collect():
        words = (r["text"] or "").encode().split()
        if len(words) < 1000:
            assert [(x["start"], x["length"], x["period"]) for x in r["runs"]] == slow_runs(words)
    key = lambda r: [(x is not None, x) for x in r]
    got = sorted((tuple(r) for r in runs.digests(runs.planted(docs.select("doc_id", "text"))).collect()), key=key)
    want = sorted((slow_digest(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 9000), key=key)
    assert [r for r in got if r[0] != 4] == want


def test_collapse_keeps_first_periods(spark):
    text = "x " + "a b c " * 6 + "y " + "z " * 20
    row = runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["collapsed"] == "x a b c y z"
