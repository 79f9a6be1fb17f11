"""Feature selection, training, evaluation and inference on the gold table."""

from __future__ import annotations

import functools

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from citylake.catalog import oracle as o
from citylake.catalog.products import gold
from citylake.catalog.registry import ORACLES, query
from citylake.catalog.views import table
from citylake.dims import LEVEL_COLOR
from citylake.functions.numeric import np_round
from citylake.ml import evaluate as ev
from citylake.ml import models as md
from citylake.ml import prep as pp
from citylake.ml import select as sel
from citylake.ml import store
from citylake.operators import measures
from citylake.plans.jobs import materialise
from citylake.session import shared_dir

TARGET = "nivel_congestion"
_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def training_rows(spark, sf):
    """Gold rows, written once: selection and training read them many times."""
    return materialise(gold(spark, sf), "training")


_PAIRS = [(a, b) for i, a in enumerate(_NUM) for b in _NUM[i + 1 :]]


@query(
    "pearson_filter",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round_even(corr({a}, {b}), 6) AS r, abs(corr({a}, {b})) > 0.9 AS descarta_b FROM lineitem" for a, b in _PAIRS),
)
def _(spark, sf):
    pairs = sel.correlation_pairs(table(spark, sf, "lineitem"), _NUM)
    return pairs.select("a", "b", np_round("r", 6).alias("r"), (F.abs("r") > 0.9).alias("descarta_b"))


@query(
    "anova_scores",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS columna, count(*) AS k, CAST(sum(n) AS BIGINT) AS n,
    round_even(((sum(s * s / n) - sum(s) * sum(s) / sum(n)) / (count(*) - 1)) / ((sum(ss) - sum(s * s / n)) / (sum(n) - count(*))), 5) AS f_value
    FROM (SELECT l_returnflag, count(*) AS n, sum(CAST({c} AS DOUBLE)) AS s, sum(CAST({c} AS DOUBLE) * {c}) AS ss FROM lineitem GROUP BY 1)"""
        for c in _NUM
    ),
)
def _(spark, sf):
    scores = sel.anova_scores(table(spark, sf, "lineitem"), _NUM, "l_returnflag")
    return scores.select("columna", "k", "n", np_round("f_value", 5).alias("f_value"))


_TXT = ["l_linestatus", "modo"]


@query(
    "chi2_scores",
    "WITH x AS (SELECT l_returnflag AS y, l_linestatus, 'm' || (l_orderkey % 7) AS modo FROM lineitem) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS columna, CAST((SELECT (count(DISTINCT {c}) - 1) * (count(DISTINCT y) - 1) FROM x) AS INTEGER) AS grados,
    round_even(sum((coalesce(n, 0) - e) * (coalesce(n, 0) - e) / e), 6) AS estadistico FROM (
      SELECT a.{c}, b.y, a.n * b.n / (SELECT count(*) FROM x)::DOUBLE AS e, o.n FROM (SELECT {c}, count(*) AS n FROM x GROUP BY 1) a
      CROSS JOIN (SELECT y, count(*) AS n FROM x GROUP BY 1) b LEFT JOIN (SELECT {c}, y, count(*) AS n FROM x GROUP BY 1, 2) o ON o.{c} = a.{c} AND o.y = b.y)"""
        for c in _TXT
    ),
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("y_txt"), "l_linestatus", F.concat(F.lit("m"), (F.col("l_orderkey") % 7).cast("string")).alias("modo")
    )
    indexed, _ = sel.index_label(rows.withColumnRenamed("y_txt", "y"), "y")
    scores = sel.chi2_scores(indexed, _TXT, "y")
    return scores.select(
        "columna", F.col("degreesOfFreedom").cast("int").alias("grados"), np_round("statistic", 6).alias("estadistico")
    )


# ---- fixed values: 5 % critical values of F (2 and many degrees) and of chi-square (2, 12) ----
_F_CUT, _CHI_CUT = 2.9957, {2: 5.9915, 12: 21.0261}
# ---- end of fixed values ------------------------------------------------------


@query("anova_select", f"SELECT columna, f_value > {_F_CUT} AS elegida FROM ({ORACLES['anova_scores']})")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "y")
    indexed, _ = sel.index_label(lines.select("y", *[F.col(c).cast("double").alias(c) for c in _NUM]), "y")
    chosen = sel.select_univariate(indexed, _NUM, "y", categorical=False)
    return spark.createDataFrame([(c, c in chosen) for c in _NUM], "columna string, elegida boolean")


@query(
    "chi2_select",
    f"SELECT columna, estadistico > CASE grados WHEN 2 THEN {_CHI_CUT[2]} WHEN 12 THEN {_CHI_CUT[12]} END AS elegida FROM ({ORACLES['chi2_scores']})",
)
def _(spark, sf):
    mode = F.concat(F.lit("m"), (F.col("l_orderkey") % 7).cast("string")).alias("modo")
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("y"), "l_linestatus", mode)
    indexed, _ = sel.index_label(rows, "y")
    chosen = sel.select_univariate(indexed, _TXT, "y", categorical=True)
    return spark.createDataFrame([(c, c in chosen) for c in _TXT], "columna string, elegida boolean")


def _rule_predictions(spark, sf):
    """The index-based rule as a predictor of the label: deterministic on both engines."""
    order = F.array(F.lit("bajo"), F.lit("medio"), F.lit("alto"))
    index = F.col("indice_congestion")
    guess = F.when(index < 1.25, 0.0).when(index < 1.60, 1.0).otherwise(2.0)
    return gold(spark, sf).select((F.array_position(order, F.col(TARGET)) - 1).cast("double").alias("y"), guess.alias("prediction"))


RULE_SQL = "p AS (SELECT CASE nivel_congestion WHEN 'bajo' THEN 0 WHEN 'medio' THEN 1 ELSE 2 END AS y, CASE WHEN indice_congestion < 1.25 THEN 0 WHEN indice_congestion < 1.60 THEN 1 ELSE 2 END AS g FROM gold)"


@query(
    "confusion_matrix",
    o.ctes(o.GOLD, RULE_SQL)
    + "SELECT CAST(c AS DOUBLE) AS clase, count(*) FILTER (WHERE g = 0) AS pred_0, count(*) FILTER (WHERE g = 1) AS pred_1, count(*) FILTER (WHERE g = 2) AS pred_2 FROM (SELECT unnest(range(3)) AS c) LEFT JOIN p ON y = c GROUP BY c",
)
def _(spark, sf):
    return ev.confusion(_rule_predictions(spark, sf), "y", 3)


#: One-vs-rest scores of the rule: the higher, the more it speaks for the class.
_CLASS_SCORES = {"bajo": "-{x}", "medio": "-abs({x} - 1.425)", "alto": "{x}"}


@query(
    "model_auc",
    o.ctes(
        o.GOLD,
        "notas AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS clase, nivel_congestion = '{c}' AS y, {e.format(x='indice_congestion').replace('1.425', '1.425::DOUBLE')} AS s FROM gold"
            for c, e in _CLASS_SCORES.items()
        )
        + " UNION ALL SELECT 'lluvia', lluvia_flag = 1, humedad_pct FROM gold)",
        "ordenado AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY clase, s) - 1) / 2.0::DOUBLE AS rango FROM notas WHERE s IS NOT NULL AND y IS NOT NULL WINDOW w AS (PARTITION BY clase ORDER BY s))",
        "areas AS (SELECT clase, count(*) FILTER (WHERE y) AS n_pos, count(*) FILTER (WHERE NOT y) AS n_neg, sum(rango) FILTER (WHERE y) AS rangos FROM ordenado GROUP BY clase)",
    )
    + "SELECT clase, n_pos, n_neg, round_even((rangos - n_pos * (n_pos + 1) / 2.0::DOUBLE) / nullif(n_pos * n_neg, 0), 9) AS auc FROM areas",
)
def _(spark, sf):
    """Exact areas under ROC: the index against each level, and humidity against rain."""
    rows = training_rows(spark, sf)
    scores = [
        F.struct(F.lit(c).alias("clase"), F.expr(e.format(x="indice_congestion")).alias("s"), (F.col(TARGET) == c).alias("y"))
        for c, e in _CLASS_SCORES.items()
    ]
    scores.append(F.struct(F.lit("lluvia").alias("clase"), F.col("humedad_pct").alias("s"), (F.col("lluvia_flag") == 1).alias("y")))
    auc = ev.exact_auc(rows.select(F.inline(F.array(*scores))), "s", "y", "clase")
    return auc.withColumn("auc", np_round("auc", 9))


SCORE_CTES = [
    "k AS (SELECT c, (SELECT count(*) FROM p WHERE y = c) AS sup, (SELECT count(*) FROM p WHERE g = c) AS said, (SELECT count(*) FROM p WHERE y = c AND g = c) AS hit FROM (SELECT unnest(range(3)) AS c))",
    "w AS (SELECT *, coalesce(hit / nullif(said, 0), 0) AS pr, coalesce(hit / nullif(sup, 0), 0) AS re FROM k)",
]
SCORE_SQL = """SELECT round_even(sum(hit) / sum(sup), 4) AS Accuracy, round_even(sum(sup * coalesce(2 * pr * re / nullif(pr + re, 0), 0)) / sum(sup), 4) AS F1_score,
    round_even(sum(sup * pr) / sum(sup), 4) AS Precision, round_even(sum(sup * re) / sum(sup), 4) AS Recall FROM w"""


@query("model_metrics", o.ctes(o.GOLD, RULE_SQL, *SCORE_CTES) + SCORE_SQL)
def _(spark, sf):
    return ev.weighted_metrics(_rule_predictions(spark, sf), "y")


@query(
    "ovr_argmax",
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS DOUBLE) AS prediction FROM embeddings",
)
def _(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", md.argmax(F.col("embedding")).alias("prediction"))


@functools.lru_cache(maxsize=1)
def compared(spark, sf):
    """Nine classifiers on the gold table and a 20 % holdout, trained once per session and table:
    the comparison table, the confusion matrices, and the rows of each class in the holdout."""
    ready = pp.prepare(training_rows(spark, sf), TARGET)
    results, fitted = ev.train_and_compare(ready, md.candidates(TARGET, ready.size, len(ready.selection.labels)))
    out = (
        materialise(results, "model-results"),
        materialise(ev.confusions(ready, fitted), "model-confusion"),
        materialise(ready.test.groupBy(F.col(TARGET).alias("clase")).agg(F.count(F.lit(1)).alias("n")), "model-holdout"),
    )
    ready.release()
    return out


MODEL_NAMES = [
    "DecisionTree", "RandomForest", "GBT (OvR manual)", "LogisticRegression", "MLP", "NaiveBayes",
    "LinearSVC (OvR)", "FMClassifier (OvR)", "OvR + LR binaria",
]


@query(
    "model_comparison",
    " UNION ALL ".join(f"SELECT {o.q(n)} AS Modelo, 'ok' AS Estado, TRUE AS en_rango, TRUE AS mejor_es_maximo" for n in MODEL_NAMES),
)
def _(spark, sf):
    """All nine classifiers: none failed, metrics are shares, the flag is on the largest F1 only."""
    results, _, _ = compared(spark, sf)
    shares = [F.col(m).between(0, 1) for m in ev.METRICS.values()]
    top = results.agg(F.max("F1_score")).scalar()
    return results.select(
        "Modelo",
        "Estado",
        functools.reduce(lambda a, b: a & b, shares).alias("en_rango"),
        ((F.col("es_mejor") == 1) == (F.col("F1_score") == top)).alias("mejor_es_maximo"),
    )


@query(
    "model_confusion",
    o.ctes(o.GOLD) + " UNION ALL ".join(f"SELECT {o.q(n)} AS Modelo, (SELECT count(DISTINCT {TARGET}) FROM gold) AS clases, TRUE AS cuadra" for n in MODEL_NAMES),
)
def _(spark, sf):
    """A confusion matrix per model, whose row sums are the holdout's rows of each class."""
    _, cells, holdout = compared(spark, sf)
    said = [c for c in cells.columns if c.startswith("pred_")]
    total = functools.reduce(lambda a, b: a + b, [F.col(c) for c in said])
    both = cells.join(holdout, "clase", "left")
    return both.groupBy("Modelo").agg(
        F.count(F.lit(1)).alias("clases"), F.bool_and(total == F.coalesce("n", F.lit(0))).alias("cuadra")
    )


@query("m_best_model")
def _(spark, sf):
    """Best-model card from a live comparison of all nine classifiers."""
    return measures.best_model(compared(spark, sf)[0])


@query("best_model_rules", "SELECT TRUE AS es_de_la_lista, TRUE AS es_el_maximo, TRUE AS color_segun_f1")
def _(spark, sf):
    """What the card must show whatever was learned: one of the nine, the largest F1, the colour of its band."""
    results = compared(spark, sf)[0]
    top = results.agg(F.max("F1_score")).scalar()
    ties = results.filter(F.col("F1_score") == top).agg(F.count(F.lit(1))).scalar()
    f1 = F.col("mejor_f1")
    band = F.when(f1 >= 0.88, 0).when(f1 >= 0.85, 1).otherwise(2)
    shown = F.array_position(F.array(*[F.lit(LEVEL_COLOR[c]) for c in ("bajo", "medio", "alto")]), F.col("color_ml")) - 1
    named = F.col("mejor_modelo").isin(MODEL_NAMES) | (F.col("mejor_modelo").isNull() & (ties > 1))
    return measures.best_model(results).select(
        named.alias("es_de_la_lista"), (f1 == top).alias("es_el_maximo"), (shown == band).alias("color_segun_f1")
    )


@query("batch_inference")
def _(spark, sf):
    """Train, save, load and relabel: unscorable rows keep the rule label."""
    rows = training_rows(spark, sf)
    ready = pp.prepare(rows, TARGET)
    mlp = next(c for c in md.candidates(TARGET, ready.size, len(ready.selection.labels)) if c.name == "MLP")
    path = shared_dir(spark, "model")
    store.save(ready, mlp.estimator.fit(ready.train), mlp.name, path)
    ready.release()
    relabelled = store.predict(rows, path)
    return relabelled.groupBy("origen_nivel", TARGET).agg(F.count(F.lit(1)).alias("n"))


@query("ovr_inference", o.ctes(o.GOLD) + "SELECT count(*) AS filas, TRUE AS iguales, TRUE AS reglas FROM gold")
def _(spark, sf):
    """A one-vs-rest model saved, loaded and applied: as the fitted one where all inputs are
    there, the rule label elsewhere, every row kept."""
    rows = training_rows(spark, sf)
    ready = pp.prepare(rows, TARGET)
    chosen = next(c for c in md.candidates(TARGET, ready.size, len(ready.selection.labels)) if c.name == "OvR + LR binaria")
    fitted, path, key = chosen.estimator.fit(ready.train), shared_dir(spark, "model"), ["zona", "fecha", "hora"]
    store.save(ready, fitted, chosen.name, path)
    direct = fitted.transform(ready.model.transform(rows.drop(TARGET))).select(
        *key, store.label_of(F.col("prediction"), ready.selection.labels).alias("directo")
    )
    ready.release()
    out = store.predict(rows, path).join(direct, key, "left").join(rows.select(*key, F.col(TARGET).alias("regla")), key)
    scored = F.col("origen_nivel") == "modelo"
    return out.agg(
        F.count(F.lit(1)).alias("filas"),
        F.bool_and(~scored | (F.col(TARGET) == F.col("directo"))).alias("iguales"),
        F.bool_and(scored | (F.col(TARGET) == F.col("regla"))).alias("reglas"),
    )


@query("embedding_classes")
def _(spark, sf):
    """Classes from raw vectors, scored on a holdout: one-vs-rest beyond three classes."""
    data = table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("y"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features_scaled"),
        F.size("embedding").alias("n"),
    )
    size, classes = data.agg(F.max("n"), F.countDistinct("y")).first()
    train, test = data.drop("n").randomSplit([0.8, 0.2], seed=pp.SEED)
    svc = next(c for c in md.candidates("y", size, classes) if c.name == "LinearSVC (OvR)")
    return ev.weighted_metrics(svc.estimator.fit(train).transform(test), "y")
