"""Streaming forms of ingest, dedup, hourly roll-up and gold refresh.

Each source runs as a query of its own, so one failing feed does not stop the
others. `once=True` processes what has arrived and stops; otherwise the query
fires on an interval.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.window import Window

from citylake.operators.upsert import newest_wins, upsert_days
from citylake.session import remove_dir, shared_dir
from citylake.sources.readers import read_or_empty
from citylake.sources.sinks import overwrite_days, with_ingest_partitions, with_lineage

INGEST_EVERY = "5 minutes"
REFRESH_EVERY = "10 minutes"
LATENESS = "24 hours"


def landed_stream(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def triggered(writer: DataStreamWriter, once: bool, every: str) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)


def with_event_time(stream: DataFrame, column: str = "_ingest_ts", lateness: str = LATENESS) -> DataFrame:
    """Watermark; rows later than the lateness are ignored, as by a 24-hour reread."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, lateness)


def ingest(
    stream: DataFrame,
    source: str,
    path: str,
    checkpoint: str,
    ingest_ts: Column | None = None,
    once: bool = False,
    by: tuple[str, ...] = ("ingest_date", "ingest_hour"),
) -> StreamingQuery:
    """Parsed payload rows to bronze, appended under ingest date and hour."""
    landed = with_ingest_partitions(with_lineage(stream, source, ingest_ts))
    writer = (
        landed.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*by)
        .queryName(f"ingest_{source}")
    )
    return triggered(writer, once, INGEST_EVERY).start()


def deduplicated(stream: DataFrame, key: list[str], lateness: str = LATENESS) -> DataFrame:
    """First arrival per key; state is kept for the watermark delay only."""
    return with_event_time(stream, "_ingest_ts", lateness).dropDuplicatesWithinWatermark(key)


def hourly_stream(
    stream: DataFrame, metrics: list[str], lateness: str = LATENESS, modes: dict[str, list[str]] | None = None
) -> DataFrame:
    """Counts and sums per zone and hour, and for `modes` a count per known value.

    Sums instead of means keep the state small and let later batches be merged;
    `hourly_means` turns them into the batch roll-up's columns.
    """
    modes = modes or {}
    counts = {f"c_{m}_{i}": F.col(m) == v for m, known in modes.items() for i, v in enumerate(known)}
    hour = F.window("_ingest_ts", "1 hour")
    return (
        with_event_time(stream, "_ingest_ts", lateness)
        .groupBy("zona", hour.alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(m).alias(f"s_{m}") for m in metrics],
            *[F.count(m).alias(f"n_{m}") for m in metrics],
            *[F.count_if(when).alias(name) for name, when in counts.items()],
        )
        .select("zona", F.col("w.start").alias("_hour"), "n", *[f"{p}_{m}" for m in metrics for p in ("s", "n")], *counts)
    )


def mode_of(column: str, known: list[str]) -> Column:
    """The value counted most often, the smallest of equals, NULL where none was seen."""
    ordered = sorted((v, F.col(f"c_{column}_{i}")) for i, v in enumerate(known))
    most = F.greatest(*[n for _, n in ordered])
    return F.when(most > 0, F.coalesce(*[F.when(n == most, F.lit(v)) for v, n in ordered]))


def hourly_means(
    table: DataFrame, metrics: list[str], digits: int = 3, modes: dict[str, list[str]] | None = None
) -> DataFrame:
    from citylake.functions.numeric import np_round

    return table.select(
        "zona",
        F.to_date("_hour").alias("fecha"),
        F.hour("_hour").alias("hora"),
        "n",
        *[np_round(F.try_divide(F.col(f"s_{m}"), F.col(f"n_{m}")), digits).alias(m) for m in metrics],
        *[mode_of(m, known).alias(m) for m, known in (modes or {}).items()],
    )


def write_changes(stream: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append each batch's updated rows as one `epoch=` folder.

    A replayed batch overwrites its own folder, so a restart after a failure
    leaves no duplicates.
    """

    def save(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save)
    return triggered(writer, once, INGEST_EVERY).start()


def read_changes(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """Newest version of every key in a change log."""
    w = Window.partitionBy(*key).orderBy(F.desc("epoch"))
    log = spark.read.parquet(path)
    return log.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "epoch")


def fold_closed(spark: SparkSession, path: str, table: str, key: list[str], hours: int = 24) -> None:
    """Move hours that the watermark has closed out of a change log into a table by day.

    The newest version of every closed hour is merged into the table first; then log
    folders that hold closed hours only are removed. Doing it again, or after a failure in
    between, changes nothing, and the log stays as long as the lateness.
    """
    log = spark.read.parquet(path)
    newest = log.agg(F.max("_hour")).first()[0]
    if newest is None:
        return
    cutoff = newest - timedelta(hours=hours)
    closed = read_changes(spark, path, key).filter(F.col("_hour") < F.lit(cutoff))
    upsert_days(closed.withColumn("fecha", F.to_date("_hour")), table, key)
    # One row per batch that is still kept.
    for row in log.groupBy("epoch").agg(F.max("_hour").alias("last")).filter(F.col("last") < F.lit(cutoff)).collect():
        remove_dir(spark, f"{path}/epoch={row.epoch}")


def read_folded(spark: SparkSession, path: str, table: str, key: list[str]) -> DataFrame:
    """Newest version of every key over the folded days and the log; the log wins."""
    log = read_changes(spark, path, key)
    stored = read_or_empty(spark, table, log.schema)
    return newest_wins([stored.select(*log.columns), log], key)


def refresh_days(
    stream: DataFrame,
    bronze_path: str,
    target: str,
    checkpoint: str,
    rebuild: Callable[[DataFrame], DataFrame],
    once: bool = False,
    margin: int = 1,
) -> StreamingQuery:
    """Recompute every day that new rows touch and replace those days only.

    A batch holds new rows alone. The days (`fecha`) it contributes to are found by
    rebuilding it, then everything landed that can belong to them is read back
    (partition-pruned), rebuilt, and only these days, now complete, are replaced;
    replaying a batch gives the same days again. A row's day may lie up to `margin`
    days from its ingest date, which covers any time zone; sources dated further from
    their ingest day pass more.
    """

    def run(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        touched = rebuild(batch).select("fecha").distinct()
        first, last = batch.agg(F.min("ingest_date"), F.max("ingest_date")).first()
        if first is None:
            return
        # A day's rows lie within the margin of it, and it within the margin of the batch.
        reach = F.sequence(F.date_sub("ingest_date", 2 * margin), F.date_add("ingest_date", 2 * margin))
        days = batch.select("ingest_date").distinct().select(F.explode(reach).alias("ingest_date")).distinct()
        wide = timedelta(days=2 * margin)
        landed = spark.read.parquet(bronze_path).filter(F.col("ingest_date").between(first - wide, last + wide))
        rebuilt = rebuild(landed.join(days, "ingest_date", "left_semi")).join(touched, "fecha", "left_semi")
        overwrite_days(rebuilt, target, "fecha")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return triggered(writer, once, REFRESH_EVERY).start()


def run_all(
    starters: dict[str, Callable[[], StreamingQuery]],
    retries: int = 0,
    poll: float = 0.5,
    stop: Callable[[], bool] = lambda: False,
) -> dict[str, str | None]:
    """Run one query per source until all have ended, and report failures by source.

    All queries are watched at once, so a failure is seen while others go on; a failed
    source starts again from its checkpoint, `retries` times at most. `stop` ends
    queries that fire on an interval.
    """
    running: dict[str, StreamingQuery] = {}
    outcome: dict[str, str | None] = {}
    failures = dict.fromkeys(starters, 0)

    def begin(name: str) -> None:
        try:
            running[name] = starters[name]()
            outcome[name] = None
        except Exception as error:  # a source that cannot start must not stop the rest
            failed(name, str(error))

    def failed(name: str, error: str) -> None:
        outcome[name] = error
        failures[name] += 1
        if failures[name] <= retries:
            begin(name)

    for name in starters:
        begin(name)
    while running:
        if stop():
            for query in running.values():
                query.stop()
        for name, query in list(running.items()):
            if not query.isActive:
                del running[name]
                if query.exception() is not None:
                    failed(name, str(query.exception()))
        if running:
            time.sleep(poll)
    return outcome


def checkpoint_path(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, f"stream-{name}")
