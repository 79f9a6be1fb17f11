"""Merging fresh rows into stored ones without a table format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citylake.operators.quality import union_common
from citylake.session import remove_dir, shared_dir
from citylake.sources.readers import read_or_empty
from citylake.sources.sinks import overwrite_days

GOLD_KEY = ["zona", "fecha", "hora"]


def newest_wins(inputs: list[DataFrame], key: list[str] = GOLD_KEY, common: bool = False, tie: list[str] = ()) -> DataFrame:
    """One row per key out of several inputs; later inputs replace earlier ones.

    `common` keeps only the columns all inputs share, otherwise the result has
    them all. `tie` orders duplicates inside one input.
    """
    out = None
    for priority, part in enumerate(inputs):
        part = part.withColumn("_priority", F.lit(priority))
        if out is None:
            out = part
        else:
            out = union_common(out, part) if common else out.unionByName(part, allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy(F.desc("_priority"), *tie)
    return out.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_priority")


def first_wins(inputs: list[DataFrame], key: list[str] = GOLD_KEY, common: bool = False) -> DataFrame:
    return newest_wins(list(reversed(inputs)), key, common)


def upsert_days(fresh: DataFrame, path: str, key: list[str] = GOLD_KEY, common: bool = False) -> None:
    """Merge into a table partitioned by `fecha`, rewriting touched days only.

    The merged days are first written to the shared folder: a plan may not read
    the files it replaces, and a lost executor then recomputes from that copy.
    Running the same upsert again gives the same table.
    """
    spark = fresh.sparkSession
    stage = shared_dir(spark, "upsert")
    fresh.write.parquet(f"{stage}/fresh")
    fresh = spark.read.schema(fresh.schema).parquet(f"{stage}/fresh")
    first, last = fresh.agg(F.min("fecha"), F.max("fecha")).first()
    if first is not None:
        days = fresh.select("fecha").distinct()
        stored = read_or_empty(spark, path, fresh.schema).filter(F.col("fecha").between(first, last))
        newest_wins([stored.join(days, "fecha", "left_semi"), fresh], key, common).write.parquet(f"{stage}/merged")
        merged = spark.read.parquet(f"{stage}/merged")
        overwrite_days(merged, path, "fecha", [c for c in key if c != "fecha"])
    remove_dir(spark, stage)


def replace_days(fresh: DataFrame, path: str) -> None:
    """Put whole recomputed days in the place of the stored ones.

    What a correction took out of a day does not stay, as it would after a merge by
    key. `fresh` may read the table it replaces: it is staged first.
    """
    spark = fresh.sparkSession
    stage = shared_dir(spark, "replace")
    fresh.write.parquet(stage)
    overwrite_days(spark.read.schema(fresh.schema).parquet(stage), path, "fecha", ["zona", "hora"])
    remove_dir(spark, stage)
