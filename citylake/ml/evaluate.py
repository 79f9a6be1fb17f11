"""Holdout metrics, confusion matrices and the model comparison table."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from citylake.functions.numeric import np_round
from citylake.ml.models import Candidate
from citylake.ml.prep import Prepared
from citylake.session import shared_dir

METRICS = {"accuracy": "Accuracy", "f1": "F1_score", "weightedPrecision": "Precision", "weightedRecall": "Recall"}


def confusion(predictions: DataFrame, label: str, classes: int) -> DataFrame:
    """Dense matrix: one row per class, one column per predicted class, zeros filled in.

    Counts are reduced to one row per (label, prediction) before the pivot.
    """
    wanted = [float(k) for k in range(classes)]
    cells = predictions.groupBy(F.col(label).cast("double").alias("clase"), F.col("prediction").cast("double").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    every = predictions.sparkSession.range(classes).select(F.col("id").cast("double").alias("clase"))
    dense = cells.unionByName(every, allowMissingColumns=True).filter(F.col("clase").isin(wanted))
    return dense.groupBy("clase").agg(
        *[F.coalesce(F.sum(F.when(F.col("p") == k, F.col("n"))), F.lit(0)).alias(f"pred_{int(k)}") for k in wanted]
    )


def weighted_metrics(predictions: DataFrame, label: str) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 as one row.

    Everything follows from the (label, prediction) counts, so one pass over the
    predictions gives all four; the rest works on classes squared rows.
    """
    cells = predictions.groupBy(F.col(label).cast("double").alias("y"), F.col("prediction").cast("double").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    actual = cells.select(F.col("y").alias("c"), F.col("n").alias("support"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit"), F.lit(0).cast("bigint").alias("said"))
    said = cells.select(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("support"), F.lit(0).cast("bigint").alias("hit"), F.col("n").alias("said"))
    per_class = actual.unionByName(said).groupBy("c").agg(
        F.sum("support").alias("support"), F.sum("hit").alias("hit"), F.sum("said").alias("said")
    )
    precision = F.coalesce(F.try_divide(F.col("hit"), F.col("said")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hit"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    total = F.sum("support")
    return per_class.agg(
        np_round(F.sum("hit") / total, 4).alias("Accuracy"),
        np_round(F.sum(F.col("support") * f1) / total, 4).alias("F1_score"),
        np_round(F.sum(F.col("support") * precision) / total, 4).alias("Precision"),
        np_round(F.sum(F.col("support") * recall) / total, 4).alias("Recall"),
    )


def multiclass_metrics(predictions: DataFrame, label: str) -> dict[str, float]:
    """`weighted_metrics` as a dict: one pass over the predictions."""
    return weighted_metrics(predictions, label).first().asDict()


def binary_auc(predictions: DataFrame, label: str) -> float:
    """Area under ROC; NaN where it is undefined: no score column, or one class only."""
    if "rawPrediction" not in predictions.columns or predictions.select(label).distinct().limit(2).count() < 2:
        return math.nan
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC").evaluate(predictions)


def exact_auc(scores: DataFrame, score: str, positive: str, by: str) -> DataFrame:
    """(by, n_pos, n_neg, auc) per group: the area under ROC as the share of positive-negative
    pairs in the right order, ties counting one half. NULL where a group has one class only.

    Equal scores become one row with two counts. Those rows are dealt by range of (group,
    score), and the negatives below a row are those below it in its range, by a window inside
    the range, and those of the group's earlier ranges. Of the ranges only their totals
    reach the driver: one row per range and group that meet. A hot group spans many ranges, a
    hot score is one row, and no window sees more than one range. Rows whose score or class
    is NULL or NaN do not count; counts are exact decimals, so the result does not depend on
    task order.
    """
    spark = scores.sparkSession
    known = scores.select(F.col(by).alias("g"), F.nanvl(F.col(score).cast("double"), F.lit(None)).alias("s"), F.col(positive).alias("p"))
    known = known.filter(F.col("s").isNotNull() & F.col("p").isNotNull())
    counted = known.groupBy("g", "s").agg(F.count_if("p").alias("pos"), F.count_if(~F.col("p")).alias("neg"))
    path = shared_dir(spark, "auc")
    counted.repartitionByRange("g", "s").withColumn("range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    totals = ranged.groupBy("range", "g").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()
    below, rows = {}, []
    for t in sorted(totals, key=lambda t: t["range"]):
        rows.append((t["range"], t["g"], below.get(t["g"], 0)))
        below[t["g"]] = below.get(t["g"], 0) + t["neg"]
    earlier = spark.createDataFrame(rows, T.StructType([ranged.schema["range"], ranged.schema["g"], T.StructField("before", T.LongType())]))
    inside = Window.partitionBy("range", "g").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("under", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    same = (placed["range"] == earlier["range"]) & placed["g"].eqNullSafe(earlier["g"])
    placed = placed.join(earlier, same).select(placed["g"], "pos", "neg", (F.col("under") + F.col("before")).alias("under"))
    won = F.col("pos").cast("decimal(19,0)") * (2 * F.col("under") + F.col("neg")).cast("decimal(19,0)")
    out = placed.groupBy("g").agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum(won).alias("won"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double") * 2
    return out.select(F.col("g").alias(by), "n_pos", "n_neg", F.try_divide(F.col("won").cast("double"), pairs).alias("auc"))


def train_and_compare(ready: Prepared, models: list[Candidate]) -> tuple[DataFrame, dict[str, object]]:
    """Fit every candidate and score it on the holdout.

    Returns the comparison table, one row per candidate and the best F1 flagged, and the
    fitted models. A failing candidate keeps its row: no metrics, the error as `Estado`.
    """
    label, rows, fitted = ready.selection.label, [], {}
    for candidate in models:
        try:
            model = candidate.estimator.fit(ready.train)
            metrics = multiclass_metrics(model.transform(ready.test), label)
        except Exception as error:  # one model must not stop the comparison
            rows.append((candidate.name, candidate.kind, *[None] * len(METRICS), f"error: {type(error).__name__}: {error}"[:500]))
            continue
        fitted[candidate.name] = model
        rows.append((candidate.name, candidate.kind, *[metrics[m] for m in METRICS.values()], "ok"))
    spark = ready.train.sparkSession
    schema = "Modelo string, Tipo string, " + ", ".join(f"{m} double" for m in METRICS.values()) + ", Estado string"
    return flag_best(spark.createDataFrame(rows, schema)), fitted


def confusions(ready: Prepared, fitted: dict[str, object]) -> DataFrame:
    """A dense confusion matrix on the holdout for every fitted model."""
    classes = len(ready.selection.labels)
    parts = [
        confusion(model.transform(ready.test), ready.selection.label, classes).withColumn("Modelo", F.lit(name))
        for name, model in fitted.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def flag_best(results: DataFrame) -> DataFrame:
    best = results.agg(F.max("F1_score")).scalar()
    return results.withColumn("es_mejor", F.coalesce((F.col("F1_score") == best).cast("int"), F.lit(0)))
