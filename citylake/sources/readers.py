"""Bronze, table and CSV scans."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.functions.numeric import lenient_timestamp, nan_to_null
from citylake.schemas import conform
from citylake.sources.files import schema_groups


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows of the same type where nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema)
        raise


def read_bronze(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Everything landed for one source, whatever folder layout it was written in.

    `recursiveFileLookup` keeps folder names out of the data: a `fecha=` folder
    would otherwise overwrite the event date stored in the file. Each path is one
    layout: its types come from one of its files, so no footer but that is read for
    them. For a path whose files disagree there is `read_drifted`.
    """
    out = None
    for path in paths:
        try:
            part = spark.read.option("recursiveFileLookup", "true").parquet(path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                continue
            raise
        part = conform(part, schema)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], schema)
    return normalise_ingest_ts(nan_to_null(out))


def read_drifted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Everything below one folder, whose files may disagree on types and columns.

    Files are grouped by the schema in their footers; each group is read with its own, cast
    to `schema` (what can't be cast is NULL) and united: as many scans as there are
    different schemas, however many files. Folder names stay out of the data.
    """
    try:
        groups = schema_groups(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            groups = []
        else:
            raise
    parts = [conform(spark.read.schema(found).parquet(*files), schema) for found, files in groups]
    if not parts:
        return spark.createDataFrame([], schema)
    return normalise_ingest_ts(nan_to_null(reduce(DataFrame.unionByName, parts)))


def normalise_ingest_ts(df: DataFrame, column: str = "_ingest_ts") -> DataFrame:
    return df.withColumn(column, lenient_timestamp(column))


def read_landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The layout this library writes, read with its declared types (`landed_schema`).

    Nothing is inferred: a column that some files lack is NULL there and never lost.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def touched_dates(as_of: datetime, hours: int) -> tuple[date, date]:
    return (as_of - timedelta(hours=hours)).date(), as_of.date()


def recent_hours(landed: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Whole days touched by the last hours; prunes on the partition column."""
    first, last = touched_dates(as_of, hours)
    return landed.filter(F.col("ingest_date").between(F.lit(first), F.lit(last)))


def recent_days(landed: DataFrame, as_of: date, days: int = 14) -> DataFrame:
    first = as_of - timedelta(days=days - 1)
    return landed.filter(F.col("ingest_date").between(F.lit(first), F.lit(as_of)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV; give a schema on large inputs, inference reads the data twice."""
    reader = spark.read.option("header", "true")
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    return reader.schema(schema).csv(path)
