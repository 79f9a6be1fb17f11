"""Feature selection, training floors, one-vs-rest, storage and inference."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from citylake.catalog.model_queries import training_rows
from citylake.ml import evaluate as ev
from citylake.ml import models as md
from citylake.ml import prep as pp
from citylake.ml import select as sel
from citylake.ml import store
from citylake.session import shared_dir

TARGET = "nivel_congestion"


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return training_rows(spark, sf_dir)


@pytest.fixture(scope="module")
def ready(rows):
    prepared = pp.prepare(rows, TARGET)
    yield prepared
    prepared.release()


def test_short_types_count_as_numeric(spark):
    df = spark.createDataFrame([], "a tinyint, b smallint, c decimal(9,2), d string, y string, y_cat string")
    assert sel.split_columns(df, "y") == (["d"], ["a", "b", "c"])


def test_collinear_columns_go_but_two_stay(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=200)
    data = [(float(a), float(2 * a), float(b)) for a, b in zip(x, rng.normal(size=200))]
    df = spark.createDataFrame(data, "a double, b double, c double")
    assert sel.drop_collinear(df, ["a", "b", "c"]) == (["a", "c"], ["b"])
    assert sel.drop_collinear(df, ["a", "b"]) == (["a", "b"], [])
    constant = df.withColumn("k", F.lit(1.0))
    assert sel.drop_collinear(constant, ["a", "k", "c"]) == (["a", "k", "c"], [])


def test_anova_matches_the_textbook_formula(spark):
    groups = {"x": [1.0, 2.0, 3.0], "y": [2.0, 4.0, 6.0], "z": [9.0, 9.5, 8.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "y string, m double")
    every = np.concatenate(list(map(np.array, groups.values())))
    between = sum(len(v) * (np.mean(v) - every.mean()) ** 2 for v in groups.values()) / 2
    within = sum(((np.array(v) - np.mean(v)) ** 2).sum() for v in groups.values()) / 6
    got = sel.anova_scores(df, ["m"], "y").head()
    assert got.f_value == pytest.approx(between / within)


def test_selection_falls_back_to_all_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0)], "a double, b double, y double")
    assert set(sel.select_univariate(df, ["a", "b"], "y", categorical=False)) <= {"a", "b"}


def test_leaky_columns_are_excluded(ready):
    assert not set(ready.selection.numeric) & set(sel.LEAKAGE)
    assert ready.selection.labels and set(ready.selection.labels) <= {"bajo", "medio", "alto"}


def test_quick_models_beat_the_majority_class(ready):
    pool = md.candidates(TARGET, ready.size, len(ready.selection.labels), iterations=20)
    assert len(pool) == 9
    quick = [c for c in pool if c.name in ("DecisionTree", "NaiveBayes", "OvR + LR binaria", "LinearSVC (OvR)")]
    results, fitted = ev.train_and_compare(ready, quick)
    got = {r.Modelo: r for r in results.collect()}
    assert set(got) == set(fitted) == {c.name for c in quick}
    assert sum(r.es_mejor for r in got.values()) >= 1
    counts = [r["count"] for r in ready.test.groupBy(TARGET).count().collect()]
    assert max(r.Accuracy for r in got.values()) >= max(counts) / sum(counts)


def test_failing_model_keeps_its_row(ready):
    class Broken:
        def fit(self, _):
            raise RuntimeError("no")

    good = next(c for c in md.candidates(TARGET, ready.size, 3) if c.name == "DecisionTree")
    results, fitted = ev.train_and_compare(ready, [md.Candidate("Broken", md.NATIVE, Broken()), good])
    got = {r.Modelo: r for r in results.collect()}
    assert set(got) == {"Broken", "DecisionTree"} and set(fitted) == {"DecisionTree"}
    assert got["Broken"].Estado == "error: RuntimeError: no" and got["Broken"].F1_score is None
    assert [got[m].es_mejor for m in ("Broken", "DecisionTree")] == [0, 1]


def test_argmax_takes_the_lowest_index_on_ties(spark):
    df = spark.createDataFrame([([0.2, 0.7, 0.7],), ([0.5, 0.5, 0.1],)], "s array<double>")
    assert [r.p for r in df.select(md.argmax(F.col("s")).alias("p")).collect()] == [1.0, 0.0]


def test_one_vs_rest_handles_four_classes(spark):
    rng = np.random.default_rng(3)
    centres = [(0, 0), (9, 0), (0, 9), (9, 9)]
    data = [(float(k), Vectors.dense(*(np.array(c) + rng.normal(size=2)))) for k, c in enumerate(centres) for _ in range(30)]
    df = spark.createDataFrame(data, ["y", "features_scaled"])
    svc = next(c for c in md.candidates("y", 2, 4) if c.name == "OvR + LR binaria")
    scored = svc.estimator.fit(df).transform(df)
    assert set(scored.columns) == {"y", "features_scaled", "prediction"}
    assert ev.multiclass_metrics(scored, "y")["Accuracy"] > 0.9


def test_metrics_agree_with_the_evaluator(spark):
    data = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (2.0, 0.0)]
    df = spark.createDataFrame(data, ["y", "prediction"])
    own = ev.weighted_metrics(df, "y").head().asDict()
    evaluator = MulticlassClassificationEvaluator(labelCol="y")
    for name, column in ev.METRICS.items():
        assert own[column] == pytest.approx(evaluator.setMetricName(name).evaluate(df), abs=5e-5)


def test_confusion_is_dense(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 2.0)], ["y", "prediction"])
    got = {r.clase: tuple(r)[1:] for r in ev.confusion(df, "y", 3).collect()}
    assert got == {0.0: (1, 0, 1), 1.0: (0, 0, 0), 2.0: (0, 0, 0)}


def test_auc(spark):
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.1)], ["y", "rawPrediction"])
    assert ev.binary_auc(df, "y") == 1.0
    assert math.isnan(ev.binary_auc(df.drop("rawPrediction"), "y"))


def test_gaussian_bayes_runs(ready):
    assert ev.multiclass_metrics(md.gaussian_bayes(TARGET).fit(ready.train).transform(ready.test), TARGET)["Accuracy"] > 0


def test_saved_model_predicts_the_same_and_rules_fill_gaps(spark, rows, ready):
    mlp = next(c for c in md.candidates(TARGET, ready.size, len(ready.selection.labels), hidden=[8], iterations=10) if c.name == "MLP")
    fitted = mlp.estimator.fit(ready.train)
    path = shared_dir(spark, "t-model")
    store.save(ready, fitted, mlp.name, path)
    assert store.describe(spark, path)["dimension"] == ready.size
    out = store.predict(rows, path)
    key = ["zona", "fecha", "hora"]
    assert out.count() == rows.count() and set(out.columns) == {*rows.columns, "origen_nivel"}
    direct = fitted.transform(ready.model.transform(rows.drop(TARGET))).select(*key, store.label_of(F.col("prediction"), ready.selection.labels).alias("want"))
    joined = out.filter("origen_nivel = 'modelo'").join(direct, key)
    assert joined.count() == direct.count() > 0
    assert joined.filter(F.col(TARGET) != F.col("want")).count() == 0
    by_rule = out.filter("origen_nivel = 'regla'").join(rows.select(*key, F.col(TARGET).alias("regla")), key)
    assert by_rule.count() > 0 and by_rule.filter(F.col(TARGET) != F.col("regla")).count() == 0


def test_best_model_is_saved_and_loaded_whatever_its_kind(spark, rows, ready):
    pool = md.candidates(TARGET, ready.size, len(ready.selection.labels))
    ovr = next(c for c in pool if c.name == "OvR + LR binaria")
    results, fitted = ev.train_and_compare(ready, [ovr])
    path = shared_dir(spark, "t-best")
    assert store.save_best(ready, results, fitted, path) == "OvR + LR binaria"
    assert store.describe(spark, path)["uno_contra_resto"]
    assert store.predict(rows, path).filter(F.col(TARGET).isNull()).count() == 0


def test_exact_auc_against_pairs(spark):
    from citylake.ml.evaluate import exact_auc

    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.choice([rng.random(), rng.randrange(4) / 4]), rng.random() < 0.3) for _ in range(800)]
    rows += [("one", 0.5, True), ("one", 0.7, True), ("a", None, True), ("a", float("nan"), False), ("b", 0.1, None), (None, 0.2, True), (None, 0.1, False)]
    frame = spark.createDataFrame(rows, "g string, s double, y boolean").repartition(5)
    got = {r["g"]: (r["n_pos"], r["n_neg"], r["auc"]) for r in exact_auc(frame, "s", "y", "g").collect()}
    for g in ("a", "b", None):
        known = [(s, y) for k, s, y in rows if k == g and y is not None and s is not None and s == s]
        pos, neg = ([s for s, y in known if y is want] for want in (True, False))
        won = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
        assert got[g] == (len(pos), len(neg), pytest.approx(won / len(pos) / len(neg), abs=1e-12))
    assert got["one"] == (2, 0, None)
    assert exact_auc(frame.filter("false"), "s", "y", "g").collect() == []
