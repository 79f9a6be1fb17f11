"""Saving and loading a trained classifier, and batch inference."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel, classification
from pyspark.ml.base import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.functions.traffic import congestion_level
from citylake.ml.models import OneVsRestModel
from citylake.ml.prep import Prepared, non_negative
from citylake.ml.select import LEAKAGE


def save(ready: Prepared, model: Model, name: str, path: str) -> None:
    """Pipeline, classifier and a one-row JSON description.

    `name` is the winner of the comparison unless the caller asks for another one. A
    one-vs-rest model is stored as its binary models, in class order.
    """
    spark = ready.train.sparkSession
    parts = model.models if isinstance(model, OneVsRestModel) else [model]
    ready.model.write().overwrite().save(f"{path}/prep")
    for k, part in enumerate(parts):
        part.write().overwrite().save(f"{path}/model/{k}")
    described = {
        "modelo": name,
        "clases": [type(part).__name__ for part in parts],
        "uno_contra_resto": isinstance(model, OneVsRestModel),
        "labels": ready.selection.labels,
        "numericas": ready.selection.numeric,
        "categoricas": ready.selection.text,
        "excluidas": LEAKAGE,
        "dimension": ready.size,
        "target": ready.selection.label,
    }
    spark.createDataFrame([(json.dumps(described),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def save_best(ready: Prepared, results: DataFrame, fitted: dict[str, Model], path: str) -> str:
    """Save the fitted model with the best F1; returns its name."""
    ranked = [r.Modelo for r in results.orderBy(F.desc_nulls_last("F1_score"), "Modelo").collect()]
    name = next(n for n in ranked if n in fitted)
    save(ready, fitted[name], name, path)
    return name


def describe(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata").head().value)


def load_model(about: dict, path: str) -> Model | OneVsRestModel:
    parts = [getattr(classification, c).load(f"{path}/model/{k}") for k, c in enumerate(about["clases"])]
    return OneVsRestModel(parts) if about["uno_contra_resto"] else parts[0]


def label_of(index: Column, labels: list[str]) -> Column:
    """Class index to label; an unknown index gives the first label."""
    names = F.array(*[F.lit(x) for x in labels])
    found = F.get(names, index.cast("int"))
    return F.when(index.isNotNull(), F.coalesce(found, F.lit(labels[0])))


def usable(columns: list[str]) -> Column:
    """All numeric inputs present, which is what the assembler requires."""
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull()
    return ok


def predict(gold: DataFrame, path: str) -> DataFrame:
    """Relabel gold rows with a stored model, in one pass and without row ids.

    The assembler keeps rows with missing inputs; their meaningless score is then
    ignored and the rule label stands.
    """
    about = describe(gold.sparkSession, path)
    prep = PipelineModel.load(f"{path}/prep")
    model = load_model(about, path)
    for stage in prep.stages:
        if isinstance(stage, VectorAssembler):
            stage.setHandleInvalid("keep")
    target, complete = about["target"], usable(about["numericas"])
    scored = model.transform(non_negative(prep.transform(gold.drop(target))))
    rule = congestion_level(F.col("congestion_factor"), F.col("indice_congestion"))
    columns = [c for c in gold.columns if c != target]
    return scored.select(
        *columns,
        F.when(complete, label_of(F.col("prediction"), about["labels"])).otherwise(rule).alias(target),
        F.when(complete, "modelo").otherwise("regla").alias("origen_nivel"),
    )
