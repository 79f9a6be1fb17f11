"""The hourly tables and the joined gold table as append-mode streams.

Every hour leaves once, when the watermark has passed its end. Cameras are two chained
aggregations: sums over the cameras of a batch window, then means over the closed batches
of an hour; the watermark travels from the first to the second. The sources meet in
stream-stream left outer joins on zone and hour window, with watermarks on both sides, so
an hour that a source has no rows for still comes out, with NULLs, and no join state
outlives the watermark.

Rows behind the watermark take no part in any of this. `split_late` keeps them apart.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citylake.operators.quality import with_defaults
from citylake.operators.rollup import camera_counts, camera_means, camera_sums, class_shares, hourly, strongest_events
from citylake.plans.gold import ABSENT, JOIN_DEFAULTS, add_features, add_label, flags_as_int
from citylake.streaming.jobs import INGEST_EVERY, LATENESS, triggered, with_event_time

#: Means, modes and digits of the sources with one level of aggregation.
ROLLUPS = {
    "clima": (["temperatura_c", "humedad_pct", "precipitacion_mm", "viento_kmh"], ["codigo_clima"], 2),
    "sensores_trafico": (["congestion_ratio", "intensidad_veh_hora"], ["nivel_servicio"], 3),
    "gps_rutas": (["congestion_factor", "velocidad_kmh", "duracion_trafico_s"], [], 3),
}


def with_hour(hours: DataFrame) -> DataFrame:
    """`fecha` and `hora` in the place of the hour window."""
    start = F.col("window.start")
    return hours.withColumns({"fecha": F.to_date(start), "hora": F.hour(start)}).drop("window")


def rolled_up(stream: DataFrame, source: str, lateness: str = LATENESS) -> DataFrame:
    """(zona, window, ...) of every closed hour of a source."""
    means, modes, digits = ROLLUPS[source]
    timed = with_event_time(stream, "_ingest_ts", lateness)
    return hourly(timed, means, modes, digits, ["zona", F.window("_ingest_ts", "1 hour")])


def cameras_rolled_up(stream: DataFrame, lateness: str = LATENESS, batch: str = INGEST_EVERY) -> DataFrame:
    """(zona, window, ...) of every closed hour of the cameras: batches sum, hours average."""
    counts = camera_counts(stream)
    timed = with_event_time(stream, "_ingest_ts", lateness)
    batches = timed.groupBy("zona", F.window("_ingest_ts", batch)).agg(*camera_sums(counts))
    means = batches.groupBy("zona", F.window("window", "1 hour")).agg(*camera_means(counts))
    return class_shares(means.withColumnRenamed("total_detectado", "total_vehiculos_zona"), counts)


def gold_stream(
    streams: dict[str, DataFrame],
    busiest: float,
    events: DataFrame | None = None,
    lateness: str = LATENESS,
    batch: str = INGEST_EVERY,
) -> DataFrame:
    """The gold table of closed hours, without news and lags: weather is the spine.

    City events are a table of days ahead, so they join as one. `busiest` is the fixed
    camera reference of the index, as in a refresh."""
    if "clima" not in streams:
        raise ValueError("weather is required")
    out = rolled_up(streams["clima"], "clima", lateness)
    for name in ("vision_camaras", "sensores_trafico", "gps_rutas"):
        if name not in streams:
            out = out.withColumns({c: F.lit(None).cast(t) for c, t in ABSENT[name].items()})
            continue
        if name == "vision_camaras":
            right = cameras_rolled_up(streams[name], lateness, batch)
        else:
            right = rolled_up(streams[name], name, lateness)
        right = right.withColumnsRenamed({"zona": "_zona", "window": "_window"})
        same = (F.col("zona") == F.col("_zona")) & (F.col("window") == F.col("_window"))
        out = out.join(right, same, "left").drop("_zona", "_window")
    out = with_hour(out).withColumn("dia_semana", F.weekday("fecha"))
    if events is not None:
        daily = strongest_events(events.withColumn("fecha", F.to_date("fecha")))
        out = out.join(daily, ["zona", "fecha"], "left")
    return flags_as_int(add_label(add_features(with_defaults(out, JOIN_DEFAULTS), busiest)))


def append_days(stream: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Closed hours appended to a table by day; the file sink's log makes each batch count once."""
    writer = stream.writeStream.outputMode("append").format("parquet").partitionBy("fecha")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return triggered(writer, once, INGEST_EVERY).start()


# ---- late rows --------------------------------------------------------------------


def watermark_before(spark: SparkSession, path: str, epoch: int) -> datetime | None:
    """The watermark that the batches before `epoch` have left, from one row per batch."""
    marks = f"{path}/watermark"
    at = spark._jvm.org.apache.hadoop.fs.Path(marks)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    rows = spark.read.schema("mark timestamp, epoch long").parquet(marks)
    return rows.filter(F.col("epoch") < epoch).agg(F.max("mark")).first()[0]


def split_late(
    stream: DataFrame, path: str, checkpoint: str, lateness: timedelta, column: str = "_ingest_ts", once: bool = False
) -> StreamingQuery:
    """Rows in time to `taken/epoch=N`, rows behind the watermark to `late/epoch=N`.

    The watermark is that of a stateful stream: the newest event time of all earlier batches
    less the lateness. It is kept per batch beside the rows, so a replayed batch is measured
    against the same one and overwrites its own folders."""

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        mark = watermark_before(spark, path, epoch)
        late = F.lit(False) if mark is None else F.coalesce(F.col(column) < F.lit(mark), F.lit(False))
        batch.filter(~late).write.mode("overwrite").parquet(f"{path}/taken/epoch={epoch}")
        if mark is not None:
            batch.filter(late).write.mode("overwrite").parquet(f"{path}/late/epoch={epoch}")
        taken = spark.read.schema(batch.schema).parquet(f"{path}/taken/epoch={epoch}")
        reached = taken.agg((F.max(column) - F.lit(lateness)).alias("mark")).filter("mark IS NOT NULL")
        reached.coalesce(1).write.mode("overwrite").parquet(f"{path}/watermark/epoch={epoch}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return triggered(writer, once, INGEST_EVERY).start()


def late_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The late table; a refresh of the days of its rows picks them up."""
    from citylake.sources.readers import read_landed

    return read_landed(spark, f"{path}/late", schema)


def with_late(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows in time and late ones together, for the days that have late rows.

    The rest of the table needs no second look, and is not read: days are matched first."""
    from citylake.sources.readers import read_landed

    taken, late = read_landed(spark, f"{path}/taken", schema), late_rows(spark, path, schema)
    days = late.select(F.to_date("_ingest_ts").alias("_day")).distinct()
    both = taken.unionByName(late).withColumn("_day", F.to_date("_ingest_ts"))
    return both.join(days, "_day", "left_semi").drop("_day")
