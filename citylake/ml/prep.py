"""Feature pipelines: indexing, scaling, one-hot encoding, split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from citylake.ml.select import LEAKAGE, drop_collinear, index_label, select_univariate, split_columns

SEED = 700


@dataclass
class Selection:
    """What survived feature selection, and what was thrown out."""

    label: str
    labels: list[str]
    numeric: list[str]
    text: list[str]
    collinear: list[str]


def choose_features(train: DataFrame, label: str, labels: list[str], limit: float = 0.95, p: float = 0.05) -> Selection:
    text, numeric = split_columns(train, label)
    kept, gone = drop_collinear(train, numeric, limit)
    return Selection(
        label,
        labels,
        select_univariate(train, kept, label, categorical=False, p=p),
        select_univariate(train, text, label, categorical=True, p=p),
        gone,
    )


def feature_pipeline(numeric: list[str], text: list[str], invalid: str = "skip") -> Pipeline:
    """Vectors `features_scaled` (standardised) and `features_nb` (min-max, for
    models that need non-negative input), each with one-hot categories appended."""
    stages = [
        VectorAssembler(inputCols=numeric, outputCol="num_features", handleInvalid=invalid),
        StandardScaler(inputCol="num_features", outputCol="num_scaled", withMean=True, withStd=True),
        MinMaxScaler(inputCol="num_features", outputCol="num_mms"),
    ]
    extra = []
    if text:
        indexed, hot = [f"{c}_idx" for c in text], [f"{c}_vec" for c in text]
        stages += [
            StringIndexer(inputCols=text, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=hot),
            VectorAssembler(inputCols=hot, outputCol="cat_features"),
        ]
        extra = ["cat_features"]
    stages += [
        VectorAssembler(inputCols=["num_scaled", *extra], outputCol="features_scaled"),
        VectorAssembler(inputCols=["num_mms", *extra], outputCol="features_nb"),
    ]
    return Pipeline(stages=stages)


def non_negative(df: DataFrame, column: str = "features_nb") -> DataFrame:
    """Rows outside the training range fall below the fitted minimum; bring them back
    to 0. So are missing inputs, whose score is not used."""
    bounded = F.transform(vector_to_array(F.col(column)), lambda x: F.greatest(F.nanvl(x, F.lit(0.0)), F.lit(0.0)))
    return df.withColumn(column, array_to_vector(bounded))


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    model: PipelineModel
    selection: Selection

    @property
    def size(self) -> int:
        """Length of the feature vector, from the fitted vector's own metadata."""
        return self.train.schema["features_scaled"].metadata["ml_attr"]["num_attrs"]

    def release(self) -> None:
        self.train.unpersist()
        self.test.unpersist()


def prepare(df: DataFrame, label: str, exclude: list[str] = LEAKAGE, share: float = 0.8, seed: int = SEED) -> Prepared:
    """Index the label, split, select and fit on the training part only.

    Both parts are persisted to memory and disk: iterative fits read them many
    times, and a lost executor recomputes its share.
    """
    indexed, labels = index_label(df.drop(*exclude), label)
    train, test = indexed.randomSplit([share, 1 - share], seed=seed)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    selection = choose_features(train, label, labels)
    model = feature_pipeline(selection.numeric, selection.text).fit(train)
    keep = [label, f"{label}_cat", "features_scaled", "features_nb"]
    ready = model.transform(train).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
    holdout = non_negative(model.transform(test)).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
    ready.count()
    train.unpersist()
    return Prepared(ready, holdout, model, selection)
