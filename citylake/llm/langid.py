"""Language identification: sparse multinomial logistic regression on TF-IDF character
n-grams, trained by FTRL with elastic-net penalties, then temperature calibration.

Document frequencies come from all learning documents. The weights are fitted on a sample
of at most `sample` documents, shared evenly among the languages and chosen by a hash of
the id; four fifths of it train, the rest sets the temperature. Prediction reads whole
texts and nothing but the text.

Cases. Null text or text without a letter: `und`, score 0. Learning rows need an id, a
text with a letter and a language; without any, everything with a letter is `und` too.
Rows with a null id are held out. Ties between languages go to the one first in order.
Very long texts are counted in runs. Repeated rows give repeated results. Other columns
are kept by `identify` and ignored by `predictions`.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.llm.common import staged, text_slices
from citylake.llm.ftrl import Ftrl, Rows, softmax

FEATURES = 1 << 15
ORDERS = 3
SAMPLE = 3000
RUN = 1 << 20
UNKNOWN = "und"
MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], np.uint32)


@functools.cache
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts_of(text: str | None) -> np.ndarray | None:
    """Counts of hashed 1- to 3-grams of the lower-cased text, letters and single blanks only;
    None if there is no letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = letter_table()[points]
    if not letters.any():
        return None
    points = np.where(letters, points, np.uint32(32))
    letters[1:] |= letters[:-1]  # one blank after a word stays
    points = np.concatenate(([np.uint32(32)], points[letters], [np.uint32(32)])).astype(np.uint32)
    total = np.zeros(FEATURES, np.int64)
    for at in range(0, len(points), RUN):
        run = points[at : at + RUN + ORDERS - 1]
        code = np.zeros(len(run), np.uint32)
        for order in range(ORDERS):
            if len(run) <= order:
                break
            code = code[: len(run) - order] + run[order:] * MULTIPLIERS[order]
            mixed = (code ^ (code >> np.uint32(15))) * np.uint32(2246822519)
            starts = mixed[:RUN]
            total += np.bincount((starts >> np.uint32(17)).astype(np.int64), minlength=FEATURES)
    return total


class Model(NamedTuple):
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    intercept: np.ndarray
    temperature: float


def weighted(features: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[features]
    return values / max(np.sqrt((values * values).sum()), 1e-12)


def predict(model: Model, text: str | None) -> tuple[str, float]:
    counts = counts_of(text) if model.languages else None
    if counts is None:
        return UNKNOWN, 0.0
    features = np.flatnonzero(counts)
    scores = weighted(features, counts[features], model.idf) @ model.weights[features] + model.intercept
    share = softmax(scores[None, :] / model.temperature)[0]
    best = int(np.argmax(share))
    return model.languages[best], float(share[best])


def held_out(id_col) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(5)) == 0, F.lit(True))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per feature over all rows of (text), and the documents with a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, np.int64)  # the last one counts documents
        for batch in batches:
            for _, part in text_slices(batch.column(0)):
                for text in part:
                    counts = counts_of(text)
                    if counts is not None:
                        total[:-1] += counts > 0
                        total[-1] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["feature", "df"])

    out = np.zeros(FEATURES + 1, np.int64)
    found = texts.mapInArrow(run, "feature long, df long").groupBy("feature").agg(F.sum("df").alias("df"))
    for row in found.collect():  # at most FEATURES + 1 rows
        out[row["feature"]] = row["df"]
    return out[:-1], int(out[-1])


def sample_counts(learn: DataFrame, languages: list[str], sample: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(language number, features, counts) of the sampled documents, in the order of the hash."""
    each = max(1, sample // max(1, len(languages)))
    # A language may hold most rows, so its ids are picked by a bounded top list per task.
    picks = [
        learn.filter(F.col("lang") == lang).select("id", F.lit(i).alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(each)
        for i, lang in enumerate(languages)
    ]
    ids = staged(reduce(DataFrame.union, picks), "langid-sample")  # at most `sample` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in text_slices(batch.column(2)):
                keep, features, counts = [], [], []
                for i, text in enumerate(part):
                    found = counts_of(text)
                    if found is not None:
                        some = np.flatnonzero(found)
                        keep.append(at + i)
                        features.append(some.astype("<u2").tobytes())
                        counts.append(np.minimum(found[some], 65535).astype("<u2").tobytes())
                rows = batch.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(features, pa.binary()), pa.array(counts, pa.binary())],
                    ["id", "label", "features", "counts"],
                )

    rows = learn.join(F.broadcast(ids), "id").select("id", "label", "text")
    found = rows.mapInArrow(run, "id long, label int, features binary, counts binary")
    one = F.min(F.struct("features", "counts")).alias("x")  # an id counts once, so the sample is bounded
    found = found.groupBy("id", "label").agg(one).orderBy(F.xxhash64("id"), "id", "label").collect()
    return [
        (r["label"], *[np.frombuffer(x, "<u2").astype(np.int64) for x in r["x"]])
        for r in found
    ]


def temperature_of(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least loss on held-back rows, by golden-section search on its log.

    As in Platt's scaling a row's target is a little less than certain, by 1 / (rows + 2), so
    separable rows don't drive the temperature to zero.
    """
    rows, classes = scores.shape
    spare = 1 / (rows + 2)
    target = np.full(scores.shape, spare / max(1, classes - 1))
    target[np.arange(rows), labels] = 1 - spare

    def loss(t: float) -> float:
        return float(-(target * np.log(np.maximum(softmax(scores / np.exp(t)), 1e-300))).sum())

    low, high, golden = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE) -> Model:
    learn = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = sorted(r["lang"] for r in learn.select("lang").distinct().collect())
    none = Model([], np.zeros(FEATURES), np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    if not languages:
        return none
    df, total = document_frequencies(learn.select("text"))
    idf = np.log((1 + total) / (1 + df)) + 1
    found = sample_counts(learn, languages, sample)
    if not found:
        return none
    labels = np.array([f[0] for f in found])
    rows = [(features, weighted(features, counts, idf)) for _, features, counts in found]
    check = np.arange(len(rows)) % 5 == 4
    fit = Rows(*map(list, zip(*[r for r, c in zip(rows, check, strict=True) if not c], strict=True)))
    model = Ftrl(FEATURES, len(languages), rate=1.0, l1=0.02, l2=0.01).fit(fit, labels[~check], epochs=5)
    temperature = 1.0
    if check.any():
        held = Rows(*map(list, zip(*[r for r, c in zip(rows, check, strict=True) if c], strict=True)))
        temperature = temperature_of(model.scores(held), labels[check])
    w = model.weights()
    return Model(languages, idf.astype(np.float32), w[:-1].astype(np.float32), w[-1], temperature)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, replacing columns of these names."""
    docs = docs.drop("lang_pred", "score")
    at, names = docs.columns.index(text_col), [*docs.columns, "lang_pred", "score"]
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in text_slices(batch.column(at)):
                langs, scores = zip(*[predict(model, t) for t in part], strict=True)
                columns = [c.slice(start, len(part)) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names
                )

    return docs.mapInArrow(run, schema)


def predictions(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    model = train(docs, id_col, text_col, lang_col, sample)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")
