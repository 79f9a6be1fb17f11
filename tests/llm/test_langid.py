import math
import zlib
from collections import Counter

import numpy as np
import pytest

from citylake.llm import langid
from citylake.llm.ftrl import Ftrl, Rows, softmax
from tests.llm.helpers import awkward, awkward_rows, clashing, empty


def slow_ngrams(text):
    """Features of the padded, lower-cased letters by a plain loop."""
    clean, last = " ", True
    for ch in text.lower():
        if ch.isalpha():
            clean, last = clean + ch, False
        elif not last:
            clean, last = clean + " ", True
    clean = clean + " " if clean != " " else ""
    counts, m = Counter(), [2654435761, 2246822519, 3266489917]
    for i in range(len(clean)):
        code = 0
        for k in range(3):
            if i + k < len(clean):
                code = (code + ord(clean[i + k]) * m[k]) % 2**32
                mixed = ((code ^ (code >> 15)) * 2246822519) % 2**32
                counts[mixed >> 17] += 1
    return counts


@pytest.mark.parametrize("text", ["a", "Hello, World", "été 12 \U0001d400 b", "日本語", "x" * 5])
@pytest.mark.parametrize("run", [3, 1 << 20])
def test_counts_against_a_loop(monkeypatch, text, run):
    monkeypatch.setattr(langid, "RUN", run)
    got = langid.counts_of(text)
    assert {i: int(got[i]) for i in np.flatnonzero(got)} == dict(slow_ngrams(text))


@pytest.mark.parametrize("text", [None, "", " \n", "123 !?"])
def test_no_letter_is_undetermined(text):
    model = langid.Model(["a"], np.ones(langid.FEATURES), np.ones((langid.FEATURES, 1)), np.zeros(1), 1.0)
    assert langid.counts_of(text) is None and langid.predict(model, text) == ("und", 0.0)


def test_ftrl_follows_the_per_coordinate_formula():
    rows = Rows([np.array([0, 1]), np.array([1])], [np.array([1.0, 2.0]), np.array([-1.0])])
    model = Ftrl(2, 2, rate=0.3, l1=0.1, l2=0.2).fit(rows, np.array([0, 1]), epochs=3, batch=1)
    z, n = [[0.0] * 2 for _ in range(3)], [[0.0] * 2 for _ in range(3)]

    def weight(i, c):
        if abs(z[i][c]) <= 0.1:
            return 0.0
        return -(z[i][c] - math.copysign(0.1, z[i][c])) / ((1 + math.sqrt(n[i][c])) / 0.3 + 0.2)

    rng, order, data = np.random.default_rng(7), np.arange(2), [({0: 1.0, 1: 2.0, 2: 1.0}, 0), ({1: -1.0, 2: 1.0}, 1)]
    for _ in range(3):
        rng.shuffle(order)
        for r in order:
            x, y = data[r]
            w = {i: [weight(i, c) for c in range(2)] for i in x}
            s = np.array([sum(v * w[i][c] for i, v in x.items()) for c in range(2)])
            p = softmax(s[None, :])[0]
            for i, v in x.items():
                for c in range(2):
                    g = v * (p[c] - (c == y))
                    z[i][c] += g - (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / 0.3 * w[i][c]
                    n[i][c] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_elastic_net_leaves_weights_at_zero(spark, sf_dir):
    model = langid.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", "lang")
    assert (model.weights == 0).mean() > 0.5 and model.temperature > 0


def test_query_held_out_accuracy(spark, sf_dir):
    from citylake.llm.queries import QUERIES

    docs = {d["doc_id"]: d for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = QUERIES["op4_language_ftrl_tfidf"](spark, sf_dir).collect()
    assert len(out) == len(docs)
    hits = []
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        if r["held_out"]:
            hits.append(r["lang_pred"] == docs[r["doc_id"]]["lang"])
    assert len(hits) > 20 and sum(hits) / len(hits) > 0.97


def test_prediction_does_not_see_labels(spark, sf_dir):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = langid.held_out(F.col("doc_id"))
    changed = docs.withColumn("lang", F.when(out, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = (langid.predictions(x).orderBy("doc_id").collect() for x in (docs, changed))
    assert a == b


@pytest.mark.parametrize("rows", [awkward, clashing])
def test_awkward_rows(spark, rows):
    out = langid.predictions(rows(spark)).collect()
    assert len(out) == len(awkward_rows())
    known = {r[2] for r in awkward_rows()} - {None}
    for r in out:
        assert r["lang_pred"] in known | {"und"} and 0 <= r["score"] <= 1
    assert {r["lang_pred"] for r in out if r["doc_id"] in (1, 2, 3)} == {"und"}


def test_empty_table(spark):
    assert langid.predictions(empty(spark)).collect() == []
