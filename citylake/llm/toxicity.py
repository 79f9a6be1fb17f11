"""Toxicity by a classifier chain.

The chain predicts one category after the other from hashed words and word beginnings; each
later linear model
also sees the probabilities of the earlier ones. In training these are out-of-fold: a row's
probability comes from a model fitted without its fold, as it will for unseen texts.

The models are fitted on at most `sample` labelled documents, chosen by a hash of the id;
prediction covers every whole text. Words are letters, digits and underscores in lower
case; a word counts once per text.

Cases. Null text and texts without a word: probabilities from the intercepts alone, never
flagged. Labels with a null id or category, and ids without a text, are not used; a
category with one class only, or none, has its share (0 without labels) as probability.
Rows that repeat an id count once in training. Very long texts are read whole. Ties do not
occur. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import runs_of, staged
from citylake.llm.ftrl import Ftrl, Rows, softmax

FEATURES = 1 << 18
SAMPLE = 10_000
FOLDS = 4
CATEGORIES = ("low_quality", "toxic")
RUN_BYTES = 6 << 20
STEMS = (4, 5, 6)
LEAST_ROWS = 3
THRESHOLD = 0.5


class Link(NamedTuple):
    """One model of the chain: words, earlier probabilities, intercept; or a fixed share."""

    words: np.ndarray
    earlier: np.ndarray
    intercept: float
    share: float | None


def codes_of(word: str) -> list[int]:
    """Hashes of a word and of its beginnings, which inflected and compound forms share."""
    if not word:
        return [-1] * (1 + len(STEMS))
    stems = [f"{word[:n]}*" if len(word) > n else word for n in STEMS]
    return [zlib.crc32(part.encode()) % FEATURES for part in (word, *stems)]


def features_of(texts: pa.Array) -> list[np.ndarray]:
    """Different hashed words and word beginnings of each text (no nulls)."""
    lists = pc.split_pattern_regex(pc.utf8_lower(texts), r"[^\pL\pN_]+")
    coded = lists.flatten().dictionary_encode()
    codes = np.array([codes_of(w) for w in coded.dictionary.to_pylist()], np.int64).reshape(-1, 1 + len(STEMS))
    words = coded.indices.to_numpy()
    edges = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
    out = [np.unique(codes[np.unique(words[i:j])]) for i, j in zip(edges, edges[1:], strict=False)]
    return [f[1:] if len(f) and f[0] < 0 else f for f in out]


def link_scores(link: Link, features: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
    """Probabilities of one category for rows with the earlier ones known."""
    if link.share is not None:
        return np.full(len(features), link.share)
    base = np.array([link.words[f].sum() for f in features]) if features else np.zeros(0)
    score = base + earlier @ link.earlier + link.intercept
    return 1 / (1 + np.exp(-np.clip(score, -40, 40)))


def chain_scores(chain: Sequence[Link], features: list[np.ndarray]) -> np.ndarray:
    """Rows x categories."""
    out = np.zeros((len(features), 0))
    for link in chain:
        out = np.column_stack((out, link_scores(link, features, out)))
    return out


def fit_link(features: list[np.ndarray], earlier: np.ndarray, labels: np.ndarray) -> Link:
    ones = float(labels.mean()) if len(labels) else 0.0
    if ones in (0.0, 1.0):
        return Link(np.zeros(0), np.zeros(earlier.shape[1]), 0.0, ones)
    extra = FEATURES + np.arange(earlier.shape[1])
    rows = Rows(
        [np.concatenate((f, extra)) for f in features],
        [np.concatenate((np.ones(len(f)), e)) for f, e in zip(features, earlier, strict=True)],
    )
    model = Ftrl(FEATURES + earlier.shape[1], 2, rate=0.5, l1=1.5, l2=0.1).fit(rows, labels, epochs=4)
    w = model.weights()
    w = w[:, 1] - w[:, 0]
    return Link(w[:FEATURES], w[FEATURES:-1], float(w[-1]), None)


def fit_chain(features: list[np.ndarray], labels: np.ndarray, folds: int = FOLDS) -> list[Link]:
    """A link per column of `labels`, later ones trained on out-of-fold probabilities."""
    fold = np.arange(len(features)) % folds
    known, chain = np.zeros((len(features), 0)), []
    for c in range(labels.shape[1]):
        chain.append(fit_link(features, known, labels[:, c]))
        if c + 1 < labels.shape[1]:
            held = np.zeros(len(features))
            for k in range(folds):
                own, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
                part = fit_link([features[i] for i in rest], known[rest], labels[rest, c])
                held[own] = link_scores(part, [features[i] for i in own], known[own])
            known = np.column_stack((known, held))
    return chain


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> list[Link]:
    """`labels` holds id and one 0/1 column per category, in the order of the chain."""
    known = labels.select(F.col("id").cast("long").alias("id"), *[F.col(c).cast("int").alias(c) for c in categories])
    known = known.na.drop().groupBy("id").agg(*[F.max(c).alias(c) for c in categories])
    picked = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    picked = staged(picked, "toxicity-sample")  # at most `sample` rows
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, size in runs_of(batch.column(1), RUN_BYTES):
                found = features_of(pc.fill_null(batch.column(1).slice(at, size), ""))
                packed = pa.array([f.astype("<u4").tobytes() for f in found], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, size), packed], ["id", "features"])

    rows = texts.filter("text IS NOT NULL").join(F.broadcast(picked.select("id")), "id", "left_semi")
    rows = rows.select("id", "text").mapInArrow(run, "id long, features binary")
    rows = rows.groupBy("id").agg(F.min("features").alias("features")).join(picked, "id")
    found = rows.orderBy(F.xxhash64("id"), "id").collect()
    features = [np.frombuffer(r["features"], "<u4").astype(np.int64) for r in found]
    if features:
        seen = np.bincount(np.concatenate(features), minlength=FEATURES) >= LEAST_ROWS
        features = [f[seen[f]] for f in features]
    return fit_chain(features, np.array([[r[c] for c in categories] for r in found], int).reshape(-1, len(categories)))


def score(
    docs: DataFrame,
    chain: list[Link],
    categories: Sequence[str] = CATEGORIES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, p_<category>..., <category>...): probabilities and verdicts of every row."""
    names = ["doc_id", *[f"p_{c}" for c in categories], *categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, size in runs_of(batch.column(1), RUN_BYTES):
                features = features_of(pc.fill_null(batch.column(1).slice(at, size), ""))
                p = chain_scores(chain, features)
                some = np.array([len(f) > 0 for f in features])
                columns = [pa.array(p[:, c]) for c in range(p.shape[1])]
                columns += [pa.array((p[:, c] >= threshold) & some) for c in range(p.shape[1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, size), *columns], names)

    schema = ", ".join(
        ["doc_id long", *[f"p_{c} double" for c in categories], *[f"{c} boolean" for c in categories]]
    )
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)
