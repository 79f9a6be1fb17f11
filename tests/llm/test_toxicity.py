import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from citylake.llm import toxicity
from citylake.llm.toxicity import FEATURES, chain_scores, features_of, fit_chain, fit_link, link_scores
from tests.llm.helpers import awkward, awkward_rows, clashing, empty


def test_features_against_a_loop():
    texts = [r[1] or "" for r in awkward_rows()] + ["Été ÉTÉ a_b a-b", "!!"]
    parts = [
        {p for w in regex.findall(r"[\p{L}\p{N}_]+", t.lower()) for p in [w, *[w[:n] + "*" for n in toxicity.STEMS if len(w) > n]]}
        for t in texts
    ]
    want = [sorted({zlib.crc32(p.encode()) % FEATURES for p in ps}) for ps in parts]
    assert [f.tolist() for f in features_of(pa.array(texts))] == want


def toy(n=400):
    rng = np.random.default_rng(1)
    first = rng.random(n) < 0.4
    second = first & (rng.random(n) < 0.7)
    features = [np.unique(np.append(rng.integers(100, 400, 12), [1] * int(f) + [2] * int(s) + [3])) for f, s in zip(first, second)]
    return features, np.column_stack((first, second)).astype(int)


def test_later_link_is_trained_on_out_of_fold_probabilities():
    features, labels = toy()
    chain = fit_chain(features, labels, folds=4)
    fold, held = np.arange(len(features)) % 4, np.zeros((len(features), 1))
    none = np.zeros((len(features), 0))
    for k in range(4):
        own, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        part = fit_link([features[i] for i in rest], none[rest], labels[rest, 0])
        held[own, 0] = link_scores(part, [features[i] for i in own], none[own])
    again = fit_link(features, held, labels[:, 1])
    assert np.array_equal(chain[1].words, again.words) and np.array_equal(chain[1].earlier, again.earlier)
    assert chain[1].earlier[0] > 0  # the second category occurs only with the first


def test_chain_feeds_earlier_probabilities():
    features, labels = toy()
    chain = fit_chain(features, labels)
    p = chain_scores(chain, features)
    assert np.array_equal(p[:, 1], link_scores(chain[1], features, p[:, :1]))
    assert ((p > 0.5) == labels).mean() > 0.9


def test_one_class_is_its_share():
    link = fit_link([np.array([1])] * 3, np.zeros((3, 0)), np.ones(3, int))
    assert link_scores(link, [np.array([], int)], np.zeros((1, 0))).tolist() == [1.0]


def test_query_finds_toxic_texts(spark, sf_dir):
    from citylake.llm.queries import QUERIES

    out = {r["doc_id"]: r for r in QUERIES["op1_toxicity_classifier_chain"](spark, sf_dir).collect()}
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert out.keys() == {d["doc_id"] for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    clean = [out[i]["toxic"] for i, r in labels.items() if r["toxic"] == 0]
    assert sum(clean) <= 0.02 * len(clean)


def test_held_out_toxic_texts_are_found(spark, sf_dir):
    """A model that flags nothing, or everything, fails here."""
    big = os.path.join(os.path.dirname(sf_dir), "sf0.1")
    if not os.path.isdir(big):
        pytest.skip("needs a larger table")
    docs = spark.read.parquet(f"{big}/documents.parquet")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    known = labels.filter(~held).select(F.col("doc_id").alias("id"), (1 - F.col("quality")).alias("low_quality"), "toxic")
    out = toxicity.score(docs, toxicity.train(docs, known)).select("doc_id", F.col("toxic").alias("found"))
    both = labels.filter(held).join(out, "doc_id").collect()
    toxic, clean = ([r["found"] for r in both if r["toxic"] == want] for want in (1, 0))
    assert len(toxic) > 20 and sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.02 * len(clean)


@pytest.mark.parametrize("rows", [awkward, clashing])
def test_awkward_rows(spark, rows):
    labels = spark.createDataFrame(
        [(4, 0, 0), (5, 1, 1), (6, 1, 1), (6, 1, 1), (None, 1, 1), (7, None, 1), (99, 1, 1)], "id long, low_quality int, toxic int"
    )
    out = toxicity.score(rows(spark), toxicity.train(rows(spark), labels)).collect()
    assert len(out) == len(awkward_rows())
    assert not any(r["toxic"] or r["low_quality"] for r in out if r["doc_id"] in (1, 2, 3))
    assert all(0 <= r[c] <= 1 for r in out for c in ("p_toxic", "p_low_quality"))


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "id long, low_quality int, toxic int")
    assert toxicity.score(empty(spark), toxicity.train(empty(spark), labels)).collect() == []
    out = toxicity.score(awkward(spark), toxicity.train(awkward(spark), labels))
    assert out.filter(F.col("toxic")).count() == 0 and out.count() == len(awkward_rows())
