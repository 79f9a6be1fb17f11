"""Streams of several sources and batches, with rows that arrive late."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from citylake.catalog import oracle as o
from citylake.catalog.products import cleaned
from citylake.catalog.registry import query
from citylake.catalog.views import SOURCES, bronze_sources, readings
from citylake.session import shared_dir
from citylake.sources.readers import read_landed
from citylake.streaming import gold as sg
from citylake.streaming import jobs as st

_TABLE_OF = {"eventos": "orders", "redes_noticias": "documents"}
_BROKEN = "gps_rutas"
_COUNTED = {n: f"(SELECT count(*) FROM {_TABLE_OF.get(n, 'events')})" for n in SOURCES} | {_BROKEN: "0::BIGINT"}


@query(
    "stream_ingest_all",
    " UNION ALL ".join(
        f"SELECT '{n}' AS fuente, {_COUNTED[n]} AS filas, {n != _BROKEN} AS entero"
        for n in SOURCES
    ),
)
def _(spark, sf):
    """Six sources as six streams, one with files that do not hold what it declares: five land in
    full, the sixth is reported."""
    inbox, bronze, starters, schemas = shared_dir(spark, "inbox"), shared_dir(spark, "bronze"), {}, {}
    for name, rows in bronze_sources(spark, sf).items():
        schemas[name] = rows.schema
        landed = rows.withColumn("velocidad_kmh", F.lit("fast")) if name == _BROKEN else rows
        landed.write.parquet(f"{inbox}/{name}")

        def start(name=name):
            stream = st.landed_stream(spark, f"{inbox}/{name}", schemas[name])
            return st.ingest(
                stream, name, f"{bronze}/{name}", st.checkpoint_path(spark, f"ingest-{name}"), F.col("_ingest_ts"), True, ("ingest_date",)
            )

        starters[name] = start
    outcome, every = st.run_all(starters), None
    for name, error in outcome.items():
        landed = read_landed(spark, f"{bronze}/{name}", schemas[name])
        counted = landed.agg(F.lit(name).alias("fuente"), F.count(F.lit(1)).alias("filas"), F.lit(error is None).alias("entero"))
        every = counted if every is None else every.unionByName(counted)
    return every


_CUTS = [datetime.datetime(2024, 1, 11), datetime.datetime(2024, 1, 21)]
_LATER = datetime.datetime(2024, 3, 1)
_REFERENCE = 99.0


def _arriving(spark, df, purpose: str, delayed, hours: int):
    """`df` landed as three files and streamed one by one: rows before each cut come first, but
    `delayed` ones of the last `hours` before it come with the next file."""
    ts, path = F.col("_ingest_ts"), shared_dir(spark, purpose)
    shift = F.when(delayed, F.expr(f"INTERVAL {hours} HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
    at = sum((F.when(ts + shift >= F.lit(cut), 1).otherwise(0) for cut in _CUTS), F.lit(0))
    for k in range(len(_CUTS) + 1):
        df.filter(at == k).coalesce(1).write.mode("append").parquet(path)
    return path


def _closing(spark, df, path: str):
    """One more file whose single row is much later: all hours before it close."""
    nothing = {c: F.lit(None).cast(t) for c, t in df.dtypes if c != "zona"}
    last = df.limit(1).withColumns({**nothing, "_ingest_ts": F.lit(_LATER).cast("timestamp")})
    last.coalesce(1).write.mode("append").parquet(path)
    return st.landed_stream(spark, path, df.schema, files_per_batch=1)


def _late_by_half_a_day(spark, sf, name: str):
    rows = cleaned(spark, sf, name)[name]
    return _closing(spark, rows, _arriving(spark, rows, f"arriving-{name}", F.col("event_id") % 5 == 0, 12))


def _appended(spark, stream, purpose: str):
    out = shared_dir(spark, purpose)
    sg.append_days(stream, out, st.checkpoint_path(spark, purpose), once=True).awaitTermination()
    return spark.read.parquet(out)


@query(
    "stream_cameras",
    o.ctes(o.READINGS, o.CAMERAS_RAW, o.SILVER_CAMERAS, o.CAMERAS_HOURLY, o.FLOW) + "SELECT * FROM g_cam LEFT JOIN g_flow USING (zona, fecha, hora)",
)
def _(spark, sf):
    """Sums per batch, then means per hour, as two chained aggregations of one stream."""
    hours = sg.cameras_rolled_up(_late_by_half_a_day(spark, sf, "vision_camaras"))
    return _appended(spark, sg.with_hour(hours), "stream-cameras")


_NO_NEWS = """g_nw AS (SELECT DATE '2024-01-01' AS fecha, 0 AS hora, 0 AS noticias_trafico_cnt, 0 AS sentimiento_negativo_cnt,
  0.0::DOUBLE AS relevance_score_max WHERE FALSE)"""
_STREAMED = ["clima", "sensores_trafico", "gps_rutas", "vision_camaras"]


@query(
    "stream_gold",
    o.ctes(
        o.GOLD.replace(o.NEWS_HOURLY, _NO_NEWS).replace(
            "(SELECT max(total_vehiculos_zona) FROM gold0) AS cam_max", f"{_REFERENCE}::DOUBLE AS cam_max"
        )
    )
    + "SELECT * EXCLUDE (congestion_factor_lag1h, indice_congestion_lag1h, tendencia_congestion) FROM gold",
)
def _(spark, sf):
    """Four streams joined on zone and hour, with city events as a table."""
    streams = {name: _late_by_half_a_day(spark, sf, name) for name in _STREAMED}
    return _appended(spark, sg.gold_stream(streams, _REFERENCE, cleaned(spark, sf, "eventos")["eventos"]), "stream-gold")


@query(
    "stream_late",
    o.ctes(
        o.READINGS,
        """p AS (SELECT event_id, fecha, ts, CAST(ts + shift >= TIMESTAMP '2024-01-11' AS INTEGER) + CAST(ts + shift >= TIMESTAMP '2024-01-21' AS INTEGER) AS part
          FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN INTERVAL 96 HOUR ELSE INTERVAL 0 HOUR END AS shift FROM r))""",
        "m AS (SELECT b.k, (SELECT max(ts) FROM p WHERE part < b.k) - INTERVAL 24 HOUR AS mark FROM (VALUES (0), (1), (2)) b(k))",
        "l AS (SELECT p.fecha, coalesce(p.ts < m.mark, FALSE) AS late FROM p JOIN m ON m.k = p.part)",
        "d AS (SELECT fecha, count(*) FILTER (WHERE NOT late) AS n_taken, count(*) FILTER (WHERE late) AS n_late, count(*) AS n FROM l GROUP BY fecha)",
    )
    + "SELECT fecha, n_taken, n_late, CASE WHEN n_late > 0 THEN n END AS n_refreshed FROM d",
)
def _(spark, sf):
    """Rows up to four days late: taken and late ones per day, and the days that have late ones redone."""
    rows = readings(spark, sf).select("event_id", "zona", F.col("ts").cast("timestamp").alias("_ingest_ts"))
    landed = _arriving(spark, rows, "late-landed", F.col("event_id") % 7 == 0, 96)
    stream, out = st.landed_stream(spark, landed, rows.schema, files_per_batch=1), shared_dir(spark, "late")
    day = datetime.timedelta(days=1)
    sg.split_late(stream, out, st.checkpoint_path(spark, "late"), day, once=True).awaitTermination()
    fecha = F.to_date("_ingest_ts").alias("fecha")
    late = sg.late_rows(spark, out, rows.schema)
    taken = spark.read.schema(rows.schema).parquet(f"{out}/taken")
    redone = sg.with_late(spark, out, rows.schema)
    kinds = {"n_taken": taken, "n_late": late, "n_refreshed": redone}
    every = None
    for name, part in kinds.items():
        counts = part.groupBy(fecha).agg(F.count(F.lit(1)).alias(name))
        every = counts if every is None else every.join(counts, "fecha", "full")
    return every.select("fecha", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_taken", "n_late")], "n_refreshed")
