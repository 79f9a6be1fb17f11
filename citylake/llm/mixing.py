"""Mixing to target weights with soft domain membership, in DataFrame operations only.

A naive Bayes classifier over present and absent word stems, fitted on a labelled table,
gives every document a posterior over domains; a document's tokens belong to the domains in these
shares. Projected gradient steps then fit one nonnegative rate per document so that the
expected tokens of each domain meet the targets in least squares. The residuals (one per
domain) are whitened by the Gram matrix of the memberships, so that a step of
length 1 is near the best; a step that does not bring the totals nearer is halved. A step
needs the domains' totals, one aggregation, and nothing per document leaves the cluster.

Cases. Null text and texts without a token have no tokens, the posterior of a text without
any telling stem, and the starting rate. Rows that repeat (id, text) are one variable and their tokens count
together. Labels with a null id or domain, and ids without a text, are not used; without
any labelled text all domains are equally likely. Empty tables give no rows. Ties cannot
occur. Other columns are ignored. Very long texts are tokenised whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import discard, staged

BUCKETS = 1 << 15
STEM = 5
PER_DOMAIN = 2000
SMOOTH = 5.0
LEAST_SHARE = 0.01
LEAST_PART = 0.8
STEPS = 80
CLOSE = 1e-7
RESTART = 8
#: White space, or the place where a word ends and other characters begin.
CUT = r"\s+|(?<=[\p{L}\p{N}])(?=[^\p{L}\p{N}\s])"


def tokens(docs: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """`keep` and the different buckets of a text's stems, one per row; the first row of each
    text (the only one, with a null bucket, if it has no tokens) carries 1 as `texts` and the
    number of its tokens as `n`, the others 0."""
    cut = F.filter(F.split(F.lower(text_col), CUT, -1), lambda t: t != "")
    # Inflected and compound forms share a beginning.
    stems = F.array_distinct(
        F.transform("cut", lambda t: F.pmod(F.xxhash64(F.left(t, F.lit(STEM))), F.lit(BUCKETS)).cast("int"))
    )
    rows = docs.select(*keep, cut.alias("cut")).select(
        *keep, F.greatest(F.size("cut"), F.lit(0)).alias("size"), F.posexplode_outer(stems).alias("at", "bucket")
    )
    first = F.coalesce(F.col("at"), F.lit(0)) == 0
    return rows.select(
        *keep, "bucket", first.cast("int").alias("texts"), F.when(first, F.col("size")).otherwise(0).alias("n")
    )


def sample(labels: DataFrame, domains: Sequence[str], per_domain: int) -> DataFrame:
    """At most `per_domain` labelled ids of each domain, by the order of a hash of the id."""
    rows = labels.filter(F.col("id").isNotNull()).select("id", "domain").distinct()
    picked = [
        rows.filter(F.col("domain") == d).orderBy(F.xxhash64("id"), "id").limit(per_domain)
        for d in domains
    ]
    return reduce(DataFrame.union, picked)


def fit_classifier(
    docs: DataFrame,
    labels: DataFrame,
    domains: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    per_domain: int = PER_DOMAIN,
) -> tuple[DataFrame, list[float]]:
    """(bucket, w_0, w_1, ...) and the intercepts of a naive Bayes classifier over present and
    absent stems: what the presence of a bucket adds to a domain's log-odds, at most BUCKETS rows.

    `labels` holds (id, domain). The sample has at most `per_domain` ids of a domain; the
    priors come from all labels. Only buckets count that LEAST_SHARE of the sample hold and
    of whose rates over the domains one makes up LEAST_PART: so the many stems that lean a
    little to a domain (as those of a language or of long texts do) don't outweigh the few
    that tell.
    """
    ks = range(len(domains))
    counts = {r["domain"]: r["n"] for r in labels.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.get(d, 0) + 1 for d in domains)
    priors = [math.log((counts.get(d, 0) + 1) / total) for d in domains]
    few = staged(sample(labels, domains, per_domain), "mixing-sample")  # <= domains * per_domain rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    texts = texts.join(F.broadcast(few), "id").groupBy("id", "domain").agg(F.min("text").alias("text"))
    texts = staged(texts, "mixing-texts")  # an id counts once
    counted = [F.count(F.when(F.col("domain") == d, 1)).alias(f"c_{k}") for k, d in enumerate(domains)]
    seen = tokens(texts, "text", "domain").groupBy("bucket").agg(*counted)
    sizes = {r["domain"]: r["n"] for r in texts.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = [float(sizes.get(d, 0)) for d in domains]
    every = max(sum(n), 1.0)
    pooled = (reduce(lambda a, b: a + b, [F.col(f"c_{k}") for k in ks]) + 0.5) / (every + 1.0)
    shares = [(F.col(f"c_{k}") + SMOOTH * F.col("pooled")) / (n[k] + SMOOTH) for k in ks]
    held = [F.col(f"q_{k}") for k in ks]
    telling = (F.greatest(*held) if len(held) > 1 else held[0]) >= LEAST_PART * reduce(lambda a, b: a + b, held)
    kept = (
        seen.filter("bucket IS NOT NULL")
        .withColumn("pooled", pooled)
        .filter(F.col("pooled") >= LEAST_SHARE)
        .select("bucket", "pooled", *[q.alias(f"q_{k}") for k, q in enumerate(shares)])
        .filter(telling)
    )
    absent = [F.log((1 - F.col(f"q_{k}")) / (1 - F.col("pooled"))) for k in ks]
    model = kept.select(
        "bucket", *[(F.log(F.col(f"q_{k}") / F.col("pooled")) - absent[k]).alias(f"w_{k}") for k in ks]
    )
    base = kept.agg(*[F.sum(a) for a in absent]).first()
    return model, [p + float(b or 0.0) for p, b in zip(priors, base, strict=True)]


def memberships(
    docs: DataFrame,
    model: DataFrame,
    intercepts: list[float],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, row, n_tokens, p_0, p_1, ...): posterior of each document."""
    ks = range(len(intercepts))
    keyed = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text")
    )
    # At most BUCKETS rows of a few doubles.
    scored = tokens(keyed, "text", "id", "row").join(F.broadcast(model), "bucket", "left")
    sums = scored.groupBy("id", "row").agg(
        F.sum("n").alias("n_tokens"),
        F.sum("texts").alias("texts"),
        *[F.sum(F.coalesce(f"w_{k}", F.lit(0.0))).alias(f"s_{k}") for k in ks],
    )
    logits = [(F.lit(intercepts[k]) + F.col(f"s_{k}") / F.col("texts")).alias(f"l_{k}") for k in ks]
    raised = sums.select("id", "row", "n_tokens", *logits)
    top = F.greatest(*[F.col(f"l_{k}") for k in ks]) if len(intercepts) > 1 else F.col("l_0")
    shares = raised.select("id", "row", "n_tokens", *[F.exp(F.col(f"l_{k}") - top).alias(f"e_{k}") for k in ks])
    whole = reduce(lambda a, b: a + b, [F.col(f"e_{k}") for k in ks])
    return shares.select("id", "row", "n_tokens", *[(F.col(f"e_{k}") / whole).alias(f"p_{k}") for k in ks])


def fit_rates(
    members: DataFrame,
    targets: Sequence[float],
    size: float = 1.0,
    least: float = 0.0,
    steps: int = STEPS,
    close: float = CLOSE,
) -> DataFrame:
    """`members` with a `rate` of at least `least` >= 0 for every row.

    `targets` are the wanted shares of the domains' expected tokens; together they come to
    `size` times the tokens there are. Steps end when the totals are within `close` of the
    targets, or no longer come nearer (targets that no rates can meet).
    """
    ks = range(len(targets))
    mass = staged(
        members.withColumn("rate", F.lit(max(1.0, least))).withColumns(
            {f"a_{k}": F.col("n_tokens") * F.col(f"p_{k}") for k in ks}
        ),
        "mixing-mass",
    )
    total = float(mass.agg(F.sum("n_tokens")).first()[0] or 0)
    if not total:
        return mass.drop(*[f"a_{k}" for k in ks])
    wanted = np.array(targets, float) / sum(targets) * total * size
    metric = _whitening(mass, ks)

    def residual(rates) -> np.ndarray:
        return np.array(mass.agg(*[F.sum(rates * F.col(f"a_{k}")) for k in ks]).first(), float) - wanted

    rate, since, length, idle = F.col("rate"), 0, 1.0, 0
    miss = residual(rate)
    for _ in range(steps):
        if np.abs(miss).max() <= close * wanted.sum() or idle >= 4:
            break
        step = length * (metric @ miss)
        move = reduce(lambda a, b: a + b, [float(step[k]) * F.col(f"a_{k}") for k in ks])
        tried = F.greatest(F.lit(float(least)), rate - move)
        found = residual(tried)
        before, after = float(miss @ metric @ miss), float(found @ metric @ found)
        idle = idle + 1 if after > before * (1 - 1e-4) else 0
        if after > before:
            length /= 2
            continue
        rate, miss, since = tried, found, since + 1
        if since == RESTART:  # keep the expression short, whiten by the rows that can move
            moved = staged(mass.withColumn("rate", rate), "mixing-mass")
            discard(mass)
            mass, rate, since, length = moved, F.col("rate"), 0, 1.0
            metric = _whitening(mass.filter(F.col("rate") > least), ks)
    return mass.withColumn("rate", rate).drop(*[f"a_{k}" for k in ks])


def _whitening(mass: DataFrame, ks: range) -> np.ndarray:
    """Inverse of the Gram matrix of the memberships: one row and column per domain."""
    cells = [F.sum(F.col(f"a_{i}") * F.col(f"a_{j}")).alias(f"g_{i}_{j}") for i in ks for j in ks if i <= j]
    gram = mass.agg(*cells).first()
    square = [[float(gram[f"g_{min(i, j)}_{max(i, j)}"] or 0) for j in ks] for i in ks]
    return np.linalg.pinv(np.array(square), rcond=1e-10, hermitian=True)


def copies(rate, *key) -> F.Column:
    """Whole copies for a rate: its integer part, and one more with the probability of the rest,
    drawn from a hash of `key`."""
    draw = F.pmod(F.xxhash64(F.lit("copies"), *key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("int")


def quality_domains(labels: DataFrame) -> DataFrame:
    """(id, domain) from a table of labels: toxic, good or poor."""
    return labels.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("toxic") == 1, "toxic")
        .when(F.col("quality") == 1, "good")
        .when(F.col("quality") == 0, "poor")
        .alias("domain"),
    ).filter(F.col("domain").isNotNull())


DOMAINS = ("good", "poor", "toxic")
TARGETS = (0.90, 0.08, 0.02)


def mix(
    docs: DataFrame,
    labels: DataFrame,
    domains: Sequence[str] = DOMAINS,
    targets: Sequence[float] = TARGETS,
    size: float = 1.0,
    least: float = 0.0,
) -> DataFrame:
    """(id, row, n_tokens, p_0, ..., rate) of `docs` (doc_id, text) for `labels` (id, domain)."""
    model, intercepts = fit_classifier(docs, labels, domains)
    return fit_rates(memberships(docs, model, intercepts), targets, size, least)


def repeat_by_rate(docs: DataFrame, rates: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of `docs` as many times as its rate says, zero times included."""
    drawn = rates.select(
        F.col("id").alias("__id"), F.col("row").alias("__row"), copies(F.col("rate"), "id", "row").alias("__copies")
    )
    drawn = staged(drawn, "mixing-copies")
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__row"))
    often = docs.join(drawn, same).filter("__copies > 0")
    return often.select(*docs.columns, F.explode(F.sequence(F.lit(1), "__copies")).alias("__n")).select(*docs.columns)
