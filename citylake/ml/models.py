"""The nine classifiers and one-vs-rest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    FMClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.ml.prep import SEED

NATIVE, OVR = "Multiclase nativo", "OvR manual"


def argmax(scores: Column) -> Column:
    """Index of the largest score as a double; the lowest index wins ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("double")


@dataclass
class OneVsRestModel:
    """One fitted binary model per class. Scoring chains them on the same rows, so
    no row id and no join is needed, for any number of classes."""

    models: list[Model]

    def transform(self, df: DataFrame) -> DataFrame:
        out, scores = df, []
        for k, model in enumerate(self.models):
            scored = model.transform(out)
            vector = "probability" if "probability" in scored.columns else "rawPrediction"
            extra = [c for c in scored.columns if c not in out.columns]
            out = scored.withColumn(f"_s{k}", F.get(vector_to_array(F.col(vector)), 1)).drop(*extra)
            scores.append(f"_s{k}")
        return out.withColumn("prediction", argmax(F.array(*scores))).drop(*scores)


@dataclass
class OneVsRest:
    """Binary classifier per class; the label is binarised with a Column."""

    factory: Callable[[str], Estimator]
    label: str
    classes: int

    def fit(self, df: DataFrame) -> OneVsRestModel:
        models = []
        for k in range(self.classes):
            binary = df.withColumn("_is", F.when(F.col(self.label) == float(k), 1.0).otherwise(0.0))
            models.append(self.factory("_is").fit(binary))
        return OneVsRestModel(models)


@dataclass
class Candidate:
    name: str
    kind: str
    estimator: Estimator | OneVsRest


def layers(size: int, hidden: list[int], classes: int) -> list[int]:
    return [size, *hidden, classes]


def candidates(label: str, size: int, classes: int, hidden: list[int] = (64, 32), features: str = "features_scaled", non_negative: str = "features_nb", iterations: int = 100) -> list[Candidate]:
    common = {"featuresCol": features, "labelCol": label}

    def ovr(build: Callable[[str], Estimator]) -> OneVsRest:
        return OneVsRest(build, label, classes)

    # Names, depths, tree counts and iterations are fixed values of the compared candidates.
    return [
        Candidate("DecisionTree", NATIVE, DecisionTreeClassifier(**common, maxDepth=5, seed=SEED)),
        Candidate("RandomForest", NATIVE, RandomForestClassifier(**common, numTrees=100, seed=SEED)),
        Candidate("GBT (OvR manual)", OVR, ovr(lambda y: GBTClassifier(featuresCol=features, labelCol=y, maxIter=20, maxDepth=4, seed=SEED))),
        Candidate("LogisticRegression", NATIVE, LogisticRegression(**common, family="multinomial", maxIter=iterations)),
        Candidate("MLP", NATIVE, MultilayerPerceptronClassifier(**common, layers=layers(size, list(hidden), classes), seed=SEED, maxIter=iterations)),
        Candidate("NaiveBayes", NATIVE, NaiveBayes(featuresCol=non_negative, labelCol=label, smoothing=1.0, modelType="multinomial")),
        Candidate("LinearSVC (OvR)", OVR, ovr(lambda y: LinearSVC(featuresCol=features, labelCol=y, maxIter=30))),
        Candidate("FMClassifier (OvR)", OVR, ovr(lambda y: FMClassifier(featuresCol=features, labelCol=y, maxIter=20, seed=SEED))),
        Candidate("OvR + LR binaria", OVR, ovr(lambda y: LogisticRegression(featuresCol=features, labelCol=y, maxIter=30))),
    ]


def gaussian_bayes(label: str, features: str = "features_scaled") -> NaiveBayes:
    return NaiveBayes(featuresCol=features, labelCol=label, modelType="gaussian")
