"""Writers: bronze append, table overwrite, CSV export, resumable backfill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citylake.dims import SOURCE_QUALITY
from citylake.functions.numeric import lenient_timestamp, lookup
from citylake.schemas import BRONZE, as_declared
from citylake.session import partition_values


def with_lineage(df: DataFrame, source: str, ingest_ts: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if ingest_ts is None else ingest_ts
    return df.withColumns(
        {
            "_fuente": F.lit(source),
            "_ingest_ts": stamp,
            "_calidad_fuente": lookup(F.lit(source), SOURCE_QUALITY, "desconocido"),
        }
    )


def with_ingest_partitions(df: DataFrame) -> DataFrame:
    return df.withColumns({"ingest_date": F.to_date("_ingest_ts"), "ingest_hour": F.hour("_ingest_ts")})


def append_bronze(
    df: DataFrame,
    source: str,
    path: str,
    ingest_ts: Column | None = None,
    by: tuple[str, ...] = ("ingest_date", "ingest_hour"),
) -> None:
    """Land a batch under its ingest date and hour; an empty batch adds no file.

    Backfills of many days pass `by=("ingest_date",)`: one folder per day holds
    fewer, larger files, and all scans prune on the date. City events are dated
    ahead of their ingest day and land under the day of the event instead. Columns
    of a known source are written in their declared types, so batches can't drift.
    """
    stamped = with_lineage(df, source, ingest_ts).withColumn("_ingest_ts", lenient_timestamp("_ingest_ts"))
    landed = with_ingest_partitions(as_declared(stamped, source) if source in BRONZE else stamped)
    if source == "eventos" and "fecha" in landed.columns:
        landed, by = landed.withColumn("event_date", F.to_date("fecha")).drop("ingest_hour"), ("event_date",)
    landed.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)


def overwrite_table(df: DataFrame, path: str, sort: list[str] | None = None) -> None:
    ordered = df.sortWithinPartitions(*sort) if sort else df
    ordered.write.mode("overwrite").parquet(path)


def overwrite_days(
    df: DataFrame, path: str, day: str = "fecha", sort: list[str] | None = None, most_rows: int | None = None
) -> None:
    """Replace only the days present in `df`.

    The rebalance hint gathers each day into few files and lets AQE split a day
    that is much larger than the rest, where a plain repartition would not. Rows of a
    file are in the order of `sort`, so its row groups do not overlap in it; a file holds
    `most_rows` at most, if given.
    """
    spread = df.hint("rebalance", day)
    if sort:
        spread = spread.sortWithinPartitions(day, *sort)
    writer = spread.write.option("maxRecordsPerFile", most_rows) if most_rows else spread.write
    (
        writer.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def order_in_files(table: DataFrame, order: list[str]) -> DataFrame:
    """(file, rows, disordered) of each Parquet file of a table: how many rows come before the
    row they follow. A window sees one file."""
    rows = table.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), F.struct(*order).alias("key"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    return rows.withColumn("before", before).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("before") > F.col("key")).alias("disordered")
    )


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with header; for KPI tables, whose size depends on zones and hours only."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").option("encoding", "UTF-8").csv(path)


def missing_days(df: DataFrame, written: DataFrame, day: str = "ingest_date") -> DataFrame:
    """Rows of days that the target does not hold yet."""
    return df.join(written.select(day).distinct(), day, "left_anti")


def written_days(spark: SparkSession, path: str, day: str) -> DataFrame:
    """Days a table holds, from its folder names."""
    names = [(v,) for v in partition_values(spark, path, day)]
    return spark.createDataFrame(names, f"{day} string").select(F.to_date(day).alias(day))


def backfill_days(df: DataFrame, path: str, day: str = "ingest_date") -> None:
    """Write the days not yet present; running it again adds nothing."""
    overwrite_days(missing_days(df, written_days(df.sparkSession, path, day), day), path, day)
