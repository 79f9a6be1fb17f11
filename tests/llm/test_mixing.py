import math
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from citylake.llm import mixing
from citylake.llm.mixing import BUCKETS, DOMAINS, fit_classifier, fit_rates, memberships, mix, quality_domains, repeat_by_rate, tokens
from tests.llm.helpers import awkward, awkward_rows, clashing, empty


def slow_tokens(text):
    cut = regex.sub(r"(?<=[\p{L}\p{N}])(?=[^\p{L}\p{N}\s])", " ", (text or "").lower())
    return [t for t in regex.split(r"[ \t\n\x0b\f\r]+", cut) if t]


def test_tokens_against_a_loop(spark):
    docs = awkward(spark).select(F.monotonically_increasing_id().alias("k"), "text")
    sums = tokens(docs, "text", "k").groupBy("k").agg(F.sum("n"), F.sum("texts"), F.countDistinct("bucket"))
    got = {r[0]: tuple(r)[1:] for r in sums.collect()}
    stems = spark.createDataFrame([(t,) for t in {t[: mixing.STEM] for r in docs.collect() for t in slow_tokens(r["text"])}], "t string")
    bucket = {r["t"]: r["b"] for r in stems.select("t", F.pmod(F.xxhash64("t"), F.lit(BUCKETS)).alias("b")).collect()}
    words = {r["k"]: slow_tokens(r["text"]) for r in docs.collect()}
    assert got == {k: (len(w), 1, len({bucket[t[: mixing.STEM]] for t in w})) for k, w in words.items()}


def test_posteriors_against_numpy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = quality_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model, intercepts = fit_classifier(docs, labels, DOMAINS)
    got = {r["id"]: r for r in memberships(docs, model, intercepts).collect()}
    domain = {r["id"]: DOMAINS.index(r["domain"]) for r in labels.collect()}
    size, sets = Counter(), {}
    for r in tokens(docs, "text", "doc_id").collect():
        size[r["doc_id"]] += r["n"]
        sets.setdefault(r["doc_id"], set()).update({r["bucket"]} - {None})
    held = np.zeros((BUCKETS, 3))
    for i, buckets in sets.items():
        if i in domain:
            held[list(buckets), domain[i]] += 1
    n = np.array([sum(domain.get(i) == k for i in sets) for k in range(3)], float)
    pooled = (held.sum(axis=1) + 0.5) / (n.sum() + 1)
    share = (held + mixing.SMOOTH * pooled[:, None]) / (n + mixing.SMOOTH)
    part = share.max(axis=1) / share.sum(axis=1)
    telling = (held.sum(axis=1) > 0) & (pooled >= mixing.LEAST_SHARE) & (part >= mixing.LEAST_PART)
    counts = Counter(domain.values())
    prior = np.log([(counts[k] + 1) / (len(domain) + 3) for k in range(3)])
    for i, buckets in sets.items():
        here = np.isin(np.arange(BUCKETS), list(buckets))
        odds = np.where(here[:, None], np.log(share / pooled[:, None]), np.log((1 - share) / (1 - pooled[:, None])))
        logit = prior + odds[telling].sum(axis=0)
        p = np.exp(logit - logit.max())
        assert np.allclose([got[i][f"p_{k}"] for k in range(3)], p / p.sum(), atol=1e-9)
        assert got[i]["n_tokens"] == size[i]


def solved(a, wanted, least=0.0, steps=4000):
    """Plain projected gradient in numpy, run to the end."""
    inverse, r = np.linalg.pinv(a.T @ a, rcond=1e-10), np.maximum(np.ones(len(a)), least)
    for _ in range(steps):
        r = np.maximum(least, r - a @ (inverse @ (a.T @ r - wanted)))
    return r


@pytest.mark.parametrize(("targets", "size", "least"), [((0.6, 0.3, 0.1), 1.0, 0.0), ((0.05, 0.05, 0.9), 1.5, 0.0), ((0.4, 0.4, 0.2), 3.0, 1.0)])
def test_rates_against_numpy(spark, targets, size, least):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.4] * 3, 300)
    n = rng.integers(0, 400, 300)
    rows = [(i, 0, int(n[i]), *map(float, p[i])) for i in range(300)]
    members = spark.createDataFrame(rows, "id long, row long, n_tokens long, p_0 double, p_1 double, p_2 double")
    out = {r["id"]: r["rate"] for r in fit_rates(members, targets, size, least).collect()}
    rates, a = np.array([out[i] for i in range(300)]), p * n[:, None]
    wanted = np.array(targets) * n.sum() * size
    assert rates.min() >= least
    assert np.allclose(a.T @ rates, wanted, rtol=1e-5)
    assert np.allclose(rates, solved(a, wanted, least), atol=1e-3)


def test_targets_out_of_reach_come_as_near_as_they_can(spark):
    members = spark.createDataFrame([(1, 0, 10, 0.5, 0.5), (2, 0, 10, 0.4, 0.6)], "id long, row long, n_tokens long, p_0 double, p_1 double")
    out = fit_rates(members, (1.0, 0.0)).collect()
    a = np.array([[5, 5], [4, 6.0]])
    want = solved(a, np.array([20.0, 0.0]))
    assert np.allclose([r["rate"] for r in sorted(out)], want, atol=1e-2)


def test_copies_follow_the_rate(spark):
    rates = spark.range(4000).select("id", F.lit(0).alias("row"), F.lit(1.25).alias("rate"))
    n = rates.select(mixing.copies(F.col("rate"), "id", "row").alias("n")).collect()
    assert {r["n"] for r in n} == {1, 2} and abs(sum(r["n"] for r in n) / 4000 - 1.25) < 0.03


@pytest.mark.parametrize("rows", [awkward, clashing])
def test_awkward_rows(spark, rows):
    labels = spark.createDataFrame([(4, "good"), (5, "poor"), (6, "poor"), (6, "poor"), (None, "good"), (99, "toxic")], "id long, domain string")
    rates = mix(rows(spark), labels)
    out = rates.collect()
    assert {(r["id"]) for r in out} == {r[0] for r in awkward_rows()}
    for r in out:
        assert r["rate"] >= 0 and math.isclose(sum(r[f"p_{k}"] for k in range(3)), 1)
    assert all(r["rate"] == 1 for r in out if r["n_tokens"] == 0)
    again = repeat_by_rate(rows(spark), rates.withColumn("rate", F.lit(2.0)))
    assert again.columns == rows(spark).columns and again.count() == 2 * len(awkward_rows())


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "id long, domain string")
    assert mix(empty(spark), labels).collect() == []
    assert mix(awkward(spark), labels).count() == len({r[:2] for r in awkward_rows()})


def test_main_path_has_no_python(spark, sf_dir):
    from citylake.llm.queries import QUERIES

    plan = QUERIES["op2_soft_membership_mixing"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_query_meets_the_targets(spark, sf_dir):
    from citylake.llm.queries import QUERIES

    out = QUERIES["op2_soft_membership_mixing"](spark, sf_dir).collect()
    total = sum(r["n_tokens"] for r in out)
    got = [sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in out) / total for d in DOMAINS]
    assert np.allclose(got, mixing.TARGETS, atol=1e-4)
