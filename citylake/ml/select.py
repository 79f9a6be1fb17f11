"""Feature selection: column split, multicollinearity, univariate tests."""

from __future__ import annotations

import math

from pyspark.ml.feature import StringIndexer, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.stat import ChiSquareTest, Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Direct ingredients of the label, and identifiers.
LEAKAGE = ["congestion_factor", "indice_congestion", "tendencia_congestion", "duracion_trafico_s", "fecha"]


def index_label(df: DataFrame, label: str) -> tuple[DataFrame, list[str]]:
    """Label as a class index; the text stays in `<label>_cat`."""
    model = StringIndexer(inputCol=label, outputCol="_label", handleInvalid="keep").fit(df)
    out = model.transform(df).withColumnRenamed(label, f"{label}_cat").withColumnRenamed("_label", label)
    return out, model.labels


def split_columns(df: DataFrame, label: str) -> tuple[list[str], list[str]]:
    """Text and numeric feature columns; every numeric type counts."""
    skip = {label, f"{label}_cat"}
    fields = [f for f in df.schema.fields if f.name not in skip]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return text, numeric


def as_vector(df: DataFrame, columns: list[str], out: str = "vec", invalid: str = "skip") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid=invalid).transform(df)


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r for every ordered pair of columns, long form; NULL where a column is constant.

    The matrix has one cell per pair of columns; its size does not depend on rows.
    """
    matrix = Correlation.corr(as_vector(df.select(*columns), columns), "vec", "pearson").head()[0].toArray()

    def cell(i: int, j: int) -> float | None:
        # A NaN left in would pass `> limit`: Spark orders NaN above every number.
        return None if math.isnan(matrix[i, j]) else float(matrix[i, j])

    rows = [(a, b, cell(i, j)) for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def drop_collinear(df: DataFrame, columns: list[str], limit: float = 0.95) -> tuple[list[str], list[str]]:
    """Kept and dropped columns: the later one of each pair beyond the limit goes,
    and a dropped column still eliminates others. Fewer than two survivors keep all."""
    if len(columns) < 2:
        return columns, []
    pairs = correlation_pairs(df, columns).filter(F.abs("r") > limit).select("b").distinct().collect()
    gone = {p.b for p in pairs}
    kept = [c for c in columns if c not in gone]
    return (kept, sorted(gone)) if len(kept) >= 2 else (columns, [])


def indexed_text(df: DataFrame, columns: list[str]) -> DataFrame:
    indexer = StringIndexer(inputCols=columns, outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep")
    return indexer.fit(df).transform(df)


def select_univariate(df: DataFrame, columns: list[str], label: str, categorical: bool, p: float = 0.05) -> list[str]:
    """Columns whose test against the label has p below the threshold (ANOVA F for
    numbers, chi-square for text). Too little data for the test keeps all."""
    if not columns or (not categorical and len(columns) < 2):
        return columns
    prepared = indexed_text(df, columns) if categorical else df
    inputs = [f"{c}_idx" for c in columns] if categorical else columns
    vectors = as_vector(prepared, inputs)
    if vectors.select(label).distinct().limit(2).count() < 2:
        return columns  # the tests are undefined with one class only
    selector = UnivariateFeatureSelector(featuresCol="vec", labelCol=label, selectionMode="fpr", outputCol="selected")
    selector.setFeatureType("categorical" if categorical else "continuous")
    selector.setLabelType("categorical").setSelectionThreshold(p)
    return [columns[i] for i in selector.fit(vectors).selectedFeatures]


def anova_scores(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """One-way F statistic of each column: one aggregation by class, one over classes."""
    whole = df.select(label, *[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    x = F.col("x.valor")
    long = whole.select(label, F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("valor")) for c in columns])).alias("x"))
    by_class = long.groupBy(F.col("x.columna").alias("columna"), label).agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("ss")
    )
    total = by_class.groupBy("columna").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum("s").alias("s"),
        F.sum("ss").alias("ss"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between"),
    )
    explained = (F.col("between") - F.col("s") * F.col("s") / F.col("n")) / (F.col("k") - 1)
    residual = (F.col("ss") - F.col("between")) / (F.col("n") - F.col("k"))
    return total.select("columna", "k", "n", F.try_divide(explained, residual).alias("f_value"))


def chi2_scores(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    prepared = indexed_text(df, columns)
    result = ChiSquareTest.test(as_vector(prepared, [f"{c}_idx" for c in columns]), "vec", label, True)
    names = F.array(*[F.lit(c) for c in columns])
    return result.select(
        F.element_at(names, F.col("featureIndex") + 1).alias("columna"), "pValue", "degreesOfFreedom", "statistic"
    )
