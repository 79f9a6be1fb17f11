"""Table round trips, resumable writes and streams (one-shot trigger)."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.catalog import oracle as o
from citylake.catalog.model_queries import MODEL_NAMES, RULE_SQL, SCORE_CTES, SCORE_SQL
from citylake.catalog.products import KPI_LONG_SQL
from citylake.catalog.registry import ORACLES, query
from citylake.catalog.views import SOURCE_ORDER, bronze_sources, readings, table
from citylake.dims import EVENT_TYPES, SENTIMENTS, SOURCE_QUALITY, ZONE_NAMES
from citylake.functions.numeric import np_round
from citylake.functions.timegrain import add_time_grain
from citylake.functions.traffic import service_level
from citylake.operators.kpi import hour_kpis
from citylake.operators.quality import first_row, require
from citylake.operators.upsert import upsert_days
from citylake.plans.jobs import PROFILE_DEFAULTS, PROFILE_METRICS
from citylake.schemas import bronze_schema, landed_schema
from citylake.session import shared_dir
from citylake.sources import readers as rd
from citylake.sources import sinks as sk
from citylake.streaming import jobs as st

R = o.ctes(o.READINGS)


def orders_by_day(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", F.to_date("o_orderdate").alias("fecha")
    )


@query(
    "parquet_roundtrip",
    "SELECT event_id, event_type, value, CAST(ts AS DATE) AS ingest_date, CAST(hour(ts) AS INTEGER) AS ingest_hour, 'eventos' AS _fuente, 'real' AS _calidad_fuente FROM events",
)
def _(spark, sf):
    path = shared_dir(spark, "bronze")
    e = table(spark, sf, "events").select("event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("_ingest_ts"))
    sk.append_bronze(e, "eventos", path, F.col("_ingest_ts"))
    return spark.read.parquet(path).drop("_ingest_ts")


@query(
    "bronze_layouts",
    R
    + """SELECT zona, CAST(k AS DOUBLE) AS intensidad_veh_hora, congestion_ratio, CASE WHEN event_id % 2 = 0 THEN CAST(k % 4 AS VARCHAR) ELSE 'C' END AS nivel_servicio,
    CASE WHEN event_id % 2 = 0 THEN 'avenida' END AS tipo_corredor, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ingest FROM r""",
)
def _(spark, sf):
    """A live and a historical layout that disagree on types and columns, read as one source."""
    r = readings(spark, sf)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    live = r.filter("event_id % 2 = 0").select(
        "zona", F.col("k").alias("intensidad_veh_hora"), "congestion_ratio", (F.col("k") % 4).cast("string").alias("nivel_servicio"),
        F.lit("avenida").alias("tipo_corredor"), F.concat(stamp, F.lit("+00:00")).alias("_ingest_ts"), F.to_date("ts").cast("string").alias("fecha"),
    )
    past = r.filter("event_id % 2 = 1").select(
        "zona", F.col("k").cast("double").alias("intensidad_veh_hora"), F.coalesce("congestion_ratio", F.lit(float("nan"))).alias("congestion_ratio"),
        F.lit("C").alias("nivel_servicio"), stamp.alias("_ingest_ts"),
    )
    root = shared_dir(spark, "layouts")
    live.write.partitionBy("fecha").parquet(f"{root}/live")
    past.write.parquet(f"{root}/2024/01")
    both = rd.read_bronze(spark, [f"{root}/live", f"{root}/2024/01", f"{root}/never_written"], bronze_schema("sensores_trafico"))
    return both.select(
        "zona", "intensidad_veh_hora", "congestion_ratio", "nivel_servicio", "tipo_corredor",
        F.date_format("_ingest_ts", "yyyy-MM-dd HH:mm:ss").alias("ingest"),
    )


def _landed(spark, sf):
    path = shared_dir(spark, "landed")
    r = readings(spark, sf).select("event_id", "zona", "v", "congestion_factor", "velocidad_kmh", F.col("ts").cast("timestamp").alias("_ingest_ts"))
    sk.append_bronze(r, "gps_rutas", path, F.col("_ingest_ts"), by=("ingest_date",))
    return path


@query("lookback_hours", R + "SELECT event_id, v, fecha AS ingest_date FROM r WHERE fecha BETWEEN DATE '2024-01-14' AND DATE '2024-01-15'")
def _(spark, sf):
    landed = spark.read.parquet(_landed(spark, sf))
    return rd.recent_hours(landed, datetime.datetime(2024, 1, 15, 10), 24).select("event_id", "v", "ingest_date")


@query("lookback_days", R + "SELECT event_id, v, fecha AS ingest_date FROM r WHERE fecha BETWEEN DATE '2024-01-02' AND DATE '2024-01-15'")
def _(spark, sf):
    landed = spark.read.parquet(_landed(spark, sf))
    return rd.recent_days(landed, datetime.date(2024, 1, 15), 14).select("event_id", "v", "ingest_date")


@query("read_or_empty", "SELECT CAST(0 AS BIGINT) AS ausentes, count(*) AS presentes FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    absent = rd.read_or_empty(spark, shared_dir(spark, "nothing-here"), orders.schema)
    tagged = absent.withColumn("hay", F.lit(False)).unionByName(orders.withColumn("hay", F.lit(True)))
    return tagged.agg(F.count_if(~F.col("hay")).alias("ausentes"), F.count_if("hay").alias("presentes"))


@query("csv_roundtrip", o.ctes(o.GOLD, o.KPI_HOUR) + "SELECT * FROM kpi_hour")
def _(spark, sf):
    from citylake.catalog.products import gold

    path = shared_dir(spark, "csv")
    series = hour_kpis(gold(spark, sf))
    sk.write_csv(series, path)
    return rd.read_csv(spark, path, series.schema)


@query("idempotent_days", "SELECT o_orderkey, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS fecha FROM orders")
def _(spark, sf):
    """Backfill one half of the days, then everything twice: each day is written once."""
    path = shared_dir(spark, "backfill")
    rows = orders_by_day(spark, sf).withColumn("mes", F.to_date(F.trunc("fecha", "month")))
    early = rows.filter(F.col("mes") < datetime.date(1998, 1, 1))
    sk.backfill_days(early, path, "mes")
    sk.backfill_days(rows, path, "mes")
    sk.backfill_days(rows.withColumn("o_totalprice", F.lit(-1.0)), path, "mes")
    return spark.read.parquet(path).drop("mes")


@query(
    "upsert_days",
    R
    + """, a AS (SELECT zona, fecha, hora, max(v) AS v FROM r WHERE fecha <= DATE '2024-01-20' GROUP BY ALL), b AS (SELECT zona, fecha, hora, min(v) AS v FROM r WHERE fecha >= DATE '2024-01-15' GROUP BY ALL)
    SELECT zona, fecha, hora, coalesce(b.v, a.v) AS v FROM a FULL JOIN b USING (zona, fecha, hora)""",
)
def _(spark, sf):
    """Two overlapping runs into a day-partitioned table; the later run wins."""
    r = readings(spark, sf)
    path = shared_dir(spark, "gold")
    key = ["zona", "fecha", "hora"]
    upsert_days(r.filter(F.col("fecha") <= datetime.date(2024, 1, 20)).groupBy(*key).agg(F.max("v").alias("v")), path)
    upsert_days(r.filter(F.col("fecha") >= datetime.date(2024, 1, 15)).groupBy(*key).agg(F.min("v").alias("v")), path)
    return spark.read.parquet(path)


# ---- streams ----------------------------------------------------------------------

_METRICS = ["congestion_factor", "velocidad_kmh"]
_MODES = {"nivel_servicio": ["A", "B", "C", "D", "E", "F"]}


def _landed_stream(spark, path):
    return st.landed_stream(spark, path, spark.read.parquet(path).schema)


@query(
    "stream_hourly",
    R
    + f""", g AS (SELECT *, {o.SERVICE.format(c='congestion_factor - 1')} AS nivel_servicio FROM r),
    m AS (SELECT zona, fecha, hora, nivel_servicio, row_number() OVER (PARTITION BY zona, fecha, hora ORDER BY count(*) DESC, nivel_servicio) AS rn
      FROM g WHERE nivel_servicio IS NOT NULL GROUP BY zona, fecha, hora, nivel_servicio)
    SELECT zona, fecha, hora, count(*) AS n, round_even(avg(congestion_factor), 3) AS congestion_factor, round_even(avg(velocidad_kmh), 3) AS velocidad_kmh,
    any_value(m.nivel_servicio) AS nivel_servicio FROM g LEFT JOIN (SELECT * FROM m WHERE rn = 1) m USING (zona, fecha, hora) GROUP BY zona, fecha, hora""",
)
def _(spark, sf):
    """Means and the most frequent service level, from counts that later batches can add to."""
    landed, log = _landed(spark, sf), shared_dir(spark, "changes")
    stream = _landed_stream(spark, landed).withColumn("nivel_servicio", service_level(F.col("congestion_factor") - 1))
    hourly = st.hourly_stream(stream, _METRICS, modes=_MODES)
    st.write_changes(hourly, log, st.checkpoint_path(spark, "hourly"), once=True).awaitTermination()
    return st.hourly_means(st.read_changes(spark, log, ["zona", "_hour"]), _METRICS, modes=_MODES)


@query("stream_dedup", R + "SELECT DISTINCT zona, strftime(ingest_ts, '%Y-%m-%d %H:%M') AS lote FROM r")
def _(spark, sf):
    """Readings of one zone and batch collapse to the first arrival."""
    landed = shared_dir(spark, "batches")
    readings(spark, sf).select("zona", "_ingest_ts", "v").write.parquet(landed)
    out = shared_dir(spark, "dedup")
    unique = st.deduplicated(_landed_stream(spark, landed), ["zona", "_ingest_ts"])
    writer = unique.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", st.checkpoint_path(spark, "dedup")
    )
    st.triggered(writer, True, st.INGEST_EVERY).start().awaitTermination()
    return spark.read.parquet(out).select("zona", F.date_format("_ingest_ts", "yyyy-MM-dd HH:mm").alias("lote"))


@query(
    "stream_upsert",
    o.ctes(o.READINGS, o.SILVER_GPS)
    + "SELECT zona, fecha, hora, round_even(avg(congestion_factor), 3) AS congestion_factor, round_even(avg(velocidad_kmh), 3) AS velocidad_kmh FROM s_gps GROUP BY zona, fecha, hora",
)
def _(spark, sf):
    """Several small batches; each recomputes the days it touches."""
    landed = shared_dir(spark, "bronze")
    r = readings(spark, sf).select("event_id", "zona", "_ingest_ts", "congestion_factor", "velocidad_kmh")
    sk.append_bronze(r, "gps_rutas", landed, F.col("_ingest_ts"), by=("ingest_date",))
    target = shared_dir(spark, "gold")

    def rebuild(bronze):
        known = require(bronze, _METRICS)
        kept = first_row(known, ["zona", "_ingest_ts"], ["event_id"]).filter(
            F.col("velocidad_kmh").between(1, 130) & F.col("congestion_factor").between(1, 5)
        )
        return add_time_grain(kept).groupBy("zona", "fecha", "hora").agg(
            *[np_round(F.avg(m), 3).alias(m) for m in _METRICS]
        )

    stream = st.landed_stream(spark, landed, spark.read.parquet(landed).schema, files_per_batch=12)
    st.refresh_days(stream, landed, target, st.checkpoint_path(spark, "refresh"), rebuild, once=True).awaitTermination()
    return spark.read.parquet(target)


_LOCAL = "(ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Lima'"


@query(
    "stream_upsert_tz",
    R
    + f"""SELECT zona, CAST({_LOCAL} AS DATE) AS fecha, CAST(hour({_LOCAL}) AS INTEGER) AS hora, count(*) AS n, max(v) AS v
    FROM r GROUP BY ALL""",
)
def _(spark, sf):
    """Days of another time zone, from batches that split them: no hour is lost."""
    landed, target = shared_dir(spark, "bronze"), shared_dir(spark, "gold")
    r = readings(spark, sf).select("event_id", "zona", "v", F.col("ts").cast("timestamp").alias("_ingest_ts"))
    sk.append_bronze(r, "gps_rutas", landed, F.col("_ingest_ts"), by=("ingest_date",))

    def rebuild(bronze):
        grained = add_time_grain(bronze, "_ingest_ts", "America/Lima")
        return grained.groupBy("zona", "fecha", "hora").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("v"))

    stream = st.landed_stream(spark, landed, spark.read.parquet(landed).schema, files_per_batch=4)
    st.refresh_days(stream, landed, target, st.checkpoint_path(spark, "refresh"), rebuild, once=True).awaitTermination()
    return spark.read.parquet(target)


@query(
    "landed_drift",
    R
    + """SELECT event_id, zona, CAST(k AS DOUBLE) AS intensidad_veh_hora, CASE WHEN fecha >= DATE '2024-01-10' THEN congestion_ratio END AS congestion_ratio,
    CASE WHEN fecha >= DATE '2024-01-20' THEN 'avenida' END AS tipo_corredor, fecha AS ingest_date FROM r""",
)
def _(spark, sf):
    """Batches that disagree on integer or double, and columns that appear later, land as declared."""
    path = shared_dir(spark, "drift")
    r = readings(spark, sf).withColumn("_ingest_ts", F.col("ts").cast("timestamp"))
    keep = ["event_id", "zona", "_ingest_ts"]
    layouts = [
        ("fecha < '2024-01-10'", [F.col("k").alias("intensidad_veh_hora")]),
        ("fecha >= '2024-01-10' AND fecha < '2024-01-20'", [F.col("k").cast("string").alias("intensidad_veh_hora"), "congestion_ratio"]),
        ("fecha >= '2024-01-20'", [F.col("k").cast("double").alias("intensidad_veh_hora"), "congestion_ratio", F.lit("avenida").alias("tipo_corredor")]),
    ]
    for when, columns in layouts:
        sk.append_bronze(r.filter(when).select(*keep, *columns), "sensores_trafico", path, F.col("_ingest_ts"), by=("ingest_date",))
    landed = rd.read_landed(spark, path, landed_schema("sensores_trafico", "event_id long"))
    return landed.select("event_id", "zona", "intensidad_veh_hora", "congestion_ratio", "tipo_corredor", "ingest_date")


@query("bronze_drift", ORACLES["landed_drift"])
def _(spark, sf):
    """Integer, text and double files and late columns below one folder, written as they came."""
    path = shared_dir(spark, "drifted")
    r = readings(spark, sf).withColumn("_ingest_ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    keep = ["event_id", "zona", "fecha", "_ingest_ts"]
    layouts = [
        ("fecha < '2024-01-10'", [F.col("k").alias("intensidad_veh_hora")]),
        ("fecha >= '2024-01-10' AND fecha < '2024-01-20'", [F.col("k").cast("string").alias("intensidad_veh_hora"), "congestion_ratio"]),
        ("fecha >= '2024-01-20'", [F.col("k").cast("double").alias("intensidad_veh_hora"), "congestion_ratio", F.lit("avenida").alias("tipo_corredor")]),
    ]
    for when, columns in layouts:
        r.filter(when).select(*keep, *columns).write.mode("append").parquet(path)
    schema = T.StructType.fromDDL(f"event_id long, fecha date, {bronze_schema('sensores_trafico').toDDL()}")
    drifted = rd.read_drifted(spark, path, schema)
    return drifted.select("event_id", "zona", "intensidad_veh_hora", "congestion_ratio", "tipo_corredor", F.col("fecha").alias("ingest_date"))


@query(
    "stream_ingest",
    R + "SELECT event_id, 'A' || k AS sensor_id, CAST(floor(v) AS INTEGER) AS intensidad, fecha AS ingest_date, 'sensores_trafico' AS _fuente FROM r",
)
def _(spark, sf):
    """Landed XML payloads parsed by a stream and appended to bronze."""
    from citylake.sources.payloads import sensor_readings

    r = readings(spark, sf)
    xml = F.concat(
        F.lit("<pms><pm><idelem>A"), F.col("k").cast("string"), F.lit("</idelem><intensidad>"),
        F.floor("v").cast("string"), F.lit("</intensidad></pm></pms>"),
    )
    inbox, bronze = shared_dir(spark, "inbox"), shared_dir(spark, "bronze")
    r.select("event_id", F.col("ts").cast("timestamp").alias("_ingest_ts"), xml.alias("payload")).write.parquet(inbox)
    parsed = sensor_readings(_landed_stream(spark, inbox), "payload", "event_id", "_ingest_ts")
    outcome = st.run_all(
        {
            "sensores_trafico": lambda: st.ingest(
                parsed, "sensores_trafico", bronze, st.checkpoint_path(spark, "ingest"), F.col("_ingest_ts"), True, ("ingest_date",)
            )
        }
    )
    if outcome["sensores_trafico"]:
        raise RuntimeError(outcome["sensores_trafico"])
    return spark.read.parquet(bronze).select("event_id", "sensor_id", "intensidad", "ingest_date", "_fuente")


# ---- composite jobs -----------------------------------------------------------------

_REFERENCE = 99.0
#: As-of time and lookback in hours of three overlapping refreshes.
_RUNS = [
    (datetime.datetime(2024, 1, 12, 23), 24 * 12),
    (datetime.datetime(2024, 1, 15, 23), 24 * 4),
    (datetime.datetime(2024, 2, 1, 23), 24 * 18),
]


def _landed_sources(spark, sf):
    """All six sources landed as bronze, one folder per source."""
    root = shared_dir(spark, "sources")
    for name, df in bronze_sources(spark, sf).items():
        sk.append_bronze(df, name, f"{root}/{name}", F.col("_ingest_ts"), by=("ingest_date",))
    return root


@query(
    "incremental_gold",
    o.ctes(o.GOLD.replace("(SELECT max(total_vehiculos_zona) FROM gold0) AS cam_max", f"{_REFERENCE}::DOUBLE AS cam_max"))
    + """SELECT zona, fecha, hora, congestion_factor, indice_congestion, congestion_factor_lag1h, indice_congestion_lag1h, tendencia_congestion, nivel_congestion, tiene_evento
    FROM gold""",
)
def _(spark, sf):
    """Three overlapping refresh runs over all days give the rows and lags of one full build."""
    from citylake.plans.jobs import refresh_gold

    bronze, out = _landed_sources(spark, sf), shared_dir(spark, "gold")
    for as_of, hours in _RUNS:
        table_ = refresh_gold(
            spark, bronze, out, list(SOURCE_ORDER), as_of, _REFERENCE, hours,
            order=SOURCE_ORDER, storage=False, extra="event_id long, doc_id long",
        )
    return table_.select(
        "zona", "fecha", "hora", "congestion_factor", "indice_congestion", "congestion_factor_lag1h",
        "indice_congestion_lag1h", "tendencia_congestion", "nivel_congestion", "tiene_evento",
    )


@query("gold_job", o.ctes(o.GOLD) + "SELECT * FROM gold")
def _(spark, sf):
    """The full rebuild with its written base, read back from the table."""
    from citylake.catalog.products import cleaned
    from citylake.plans.jobs import build_gold

    return build_gold(cleaned(spark, sf), shared_dir(spark, "gold"), storage=False)


def _long_sql(table_: str, source: str, key: str, numbers: list[str], texts: list[str] = (), digits: int = 9) -> str:
    """A table as rows (tabla, clave, metrica, texto, numero); numbers to nine digits."""
    head = f"SELECT '{table_}' AS tabla, CAST({key} AS VARCHAR) AS clave"
    parts = [f"{head}, '{c}' AS metrica, CAST(NULL AS VARCHAR) AS texto, round_even(CAST({c} AS DOUBLE), {digits}) AS numero FROM {source}" for c in numbers]
    parts += [f"{head}, '{c}' AS metrica, {c} AS texto, CAST(NULL AS DOUBLE) AS numero FROM {source}" for c in texts]
    return " UNION ALL ".join(parts)


def _long(df, table_: str, key, numbers: list[str], texts: list[str] = (), digits: int = 9):
    none = {"texto": F.lit(None).cast("string"), "numero": F.lit(None).cast("double")}

    def cell(c: str, **value):
        return F.struct(F.lit(c).alias("metrica"), *[(none | value)[n].alias(n) for n in none])

    cells = [cell(c, numero=np_round(F.col(c).cast("double"), digits)) for c in numbers]
    cells += [cell(c, texto=F.col(c)) for c in texts]
    return df.select(F.lit(table_).alias("tabla"), key.cast("string").alias("clave"), F.inline(F.array(*cells)))


_ZONE_NUMBERS = [
    "velocidad_kmh", "congestion_ratio", "intensidad_veh_hora", "total_vehiculos",
    "pct_alto", "pct_medio", "pct_bajo", "registros", "lat", "lon",
]
_HOUR_NUMBERS = ["velocidad_kmh", "congestion_ratio", "intensidad_veh_hora", "pct_alto", "es_hora_punta"]
_SCORES = ["Accuracy", "F1_score", "Precision", "Recall"]
#: table -> (source in the SQL, key in SQL and in Spark, numbers, texts)
_EXPORTED = {
    "kpi_resumen": ("kpi_global", "KPI", "KPI", [], ["Valor", "Unidad"]),
    "kpi_por_zona": ("kpi_zone", "zona", "zona", _ZONE_NUMBERS, ["nivel_dominante"]),
    "kpi_resumen_por_zona": ("kz_long", "zona || '/' || KPI", "concat(zona, '/', KPI)", [], ["Valor", "Unidad"]),
    "kpi_serie_temporal": ("kpi_hour", "hora", "hora", _HOUR_NUMBERS, ["hora_label"]),
    "kpi_composicion": ("kpi_composition", "tipo_vehiculo", "tipo_vehiculo", ["porcentaje", "porcentaje_norm"], []),
    "kpi_ml_resultados": ("scored", "'Regla'", "Modelo", _SCORES, []),
}


@query(
    "kpi_export",
    o.ctes(
        o.GOLD, o.LATEST, o.KPI_GLOBAL, o.KPI_ZONE, o.KPI_HOUR, o.KPI_COMPOSITION,
        "kz AS (SELECT k.*, l.velocidad_kmh AS vel_ultima FROM kpi_zone k JOIN latest l USING (zona))",
        f"kz_long AS ({KPI_LONG_SQL})",
        RULE_SQL,
        *SCORE_CTES,
        f"scored AS ({SCORE_SQL})",
    )
    + " UNION ALL ".join(_long_sql(t, src, key, n, x) for t, (src, key, _, n, x) in _EXPORTED.items()),
)
def _(spark, sf):
    """All six KPI tables to CSV, every one read back."""
    from citylake.catalog.model_queries import _rule_predictions
    from citylake.catalog.products import gold
    from citylake.ml.evaluate import weighted_metrics
    from citylake.plans.jobs import export_kpis, kpi_tables, materialise

    path, rows = shared_dir(spark, "kpis"), materialise(gold(spark, sf), "kpi-gold")
    scores = weighted_metrics(_rule_predictions(spark, sf), "y").withColumn("Modelo", F.lit("Regla"))
    export_kpis(rows, path, scores)
    schemas = {n: t.schema for n, t in {**kpi_tables(rows), "kpi_ml_resultados": scores}.items()}
    parts = [
        _long(rd.read_csv(spark, f"{path}/{t}", schemas[t]), t, F.expr(key), n, x)
        for t, (_, _, key, n, x) in _EXPORTED.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_INCREMENTAL = {t: v for t, v in _EXPORTED.items() if t != "kpi_ml_resultados"}


@query(
    "kpi_incremental",
    o.ctes(
        o.GOLD.replace("(SELECT max(total_vehiculos_zona) FROM gold0) AS cam_max", f"{_REFERENCE}::DOUBLE AS cam_max"),
        o.LATEST, o.KPI_GLOBAL, o.KPI_ZONE, o.KPI_HOUR, o.KPI_COMPOSITION,
        "kz AS (SELECT k.*, l.velocidad_kmh AS vel_ultima FROM kpi_zone k JOIN latest l USING (zona))",
        f"kz_long AS ({KPI_LONG_SQL})",
    )
    + " UNION ALL ".join(_long_sql(t, src, key, n, x) for t, (src, key, _, n, x) in _INCREMENTAL.items()),
)
def _(spark, sf):
    """Three overlapping refreshes, each adding up sums per day; the export of the last one."""
    from citylake.plans.jobs import kpi_tables_of, refresh_gold

    bronze, out, path = _landed_sources(spark, sf), shared_dir(spark, "gold"), shared_dir(spark, "kpis")
    for as_of, hours in _RUNS:
        refresh_gold(
            spark, bronze, out, list(SOURCE_ORDER), as_of, _REFERENCE, hours,
            order=SOURCE_ORDER, storage=False, extra="event_id long, doc_id long", kpis=path,
        )
    schemas = {n: t.schema for n, t in kpi_tables_of(spark.read.parquet(f"{out}/kpi_parciales")).items()}
    parts = [
        _long(rd.read_csv(spark, f"{path}/{t}", schemas[t]), t, F.expr(key), n, x) for t, (_, _, key, n, x) in _INCREMENTAL.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_LEARNED = [f"{p}_{m}" for m in PROFILE_METRICS for p in ("mean", "std")]
_PROFILE_CTES = [
    "m AS (SELECT max(fecha) AS f FROM gold)",
    "p AS (SELECT * FROM gold WHERE fecha >= (SELECT f FROM m) - 7)",
    f"z AS (SELECT zona, CAST(unnest(range(24)) AS INTEGER) AS hora FROM (SELECT unnest({o.sql_list(ZONE_NAMES)}) AS zona))",
    "pr AS (SELECT zona, hora, "
    + ", ".join(
        f"coalesce({o.exact(m, 4)}, 0.0::DOUBLE) AS mean_{m}, greatest(coalesce(stddev_samp({m}), 0.01::DOUBLE), 0.01::DOUBLE) AS std_{m}"
        for m in PROFILE_METRICS
    )
    + " FROM p GROUP BY zona, hora HAVING count(*) >= 2)",
    "nb AS (SELECT z.zona, z.hora, " + ", ".join(f"avg(pr.{c}) AS {c}" for c in _LEARNED)
    + " FROM z JOIN pr ON pr.zona = z.zona AND (pr.hora - z.hora + 24) % 24 IN (1, 2, 22, 23) GROUP BY z.zona, z.hora)",
    "perfil AS (SELECT z.zona || '/' || z.hora AS k, "
    + ", ".join(
        f"CASE WHEN pr.zona IS NOT NULL THEN pr.{c} ELSE coalesce(nb.{c}, CAST({PROFILE_DEFAULTS.get(c, 'NULL')} AS DOUBLE)) END AS {c}"
        for c in _LEARNED
    )
    + " FROM z LEFT JOIN pr USING (zona, hora) LEFT JOIN nb USING (zona, hora))",
    f"a AS (SELECT {o.exact('congestion_ratio', 4)} AS a FROM p)",
    f"d AS (SELECT dia_semana, {o.exact('congestion_ratio', 4)} AS f FROM p GROUP BY dia_semana)",
    "dia AS (SELECT w.dia_semana AS k, coalesce(f / nullif((SELECT a FROM a), 0), 1.0::DOUBLE) AS factor FROM (SELECT CAST(unnest(range(7)) AS INTEGER) AS dia_semana) w LEFT JOIN d USING (dia_semana))",
    "c AS (SELECT zona, hora, count(*) AS n, count(*) FILTER (WHERE nivel_congestion = 'alto') AS a, count(*) FILTER (WHERE nivel_congestion = 'medio') AS m, count(*) FILTER (WHERE nivel_congestion = 'bajo') AS b FROM p GROUP BY zona, hora)",
    """q AS (SELECT zona, hora, CASE WHEN n >= 3 AND a > 0 THEN a / n ELSE 0.33::DOUBLE END AS pa, CASE WHEN n >= 3 AND m > 0 THEN m / n ELSE 0.34::DOUBLE END AS pm,
    CASE WHEN n >= 3 AND b > 0 THEN b / n ELSE 0.33::DOUBLE END AS pb FROM z LEFT JOIN c USING (zona, hora))""",
    "nivel AS (SELECT zona || '/' || hora AS k, pa / (pa + pm + pb) AS p_alto, pm / (pa + pm + pb) AS p_medio, pb / (pa + pm + pb) AS p_bajo FROM q)",
    f"t AS (SELECT unnest({o.sql_list(EVENT_TYPES)}) AS tipo)",
    f"s AS (SELECT t.tipo, CASE WHEN count(e.tipo) > 0 THEN count(e.tipo) / (SELECT count(tipo) FROM s_ev) ELSE 1.0::DOUBLE / {len(EVENT_TYPES)} END AS pt FROM t LEFT JOIN s_ev e USING (tipo) GROUP BY t.tipo)",
    "ev AS (SELECT tipo AS k, (SELECT count(*) / greatest(count(DISTINCT fecha) * 6, 1) FROM s_ev) AS prob_evento, pt / (SELECT sum(pt) FROM s) AS prob_tipo FROM s)",
    "nw AS (SELECT count(*) AS n, count(DISTINCT (fecha, hora)) AS b, count(*) FILTER (WHERE es_trafico) AS tr, "
    + ", ".join(f"CASE WHEN count(*) FILTER (WHERE sentiment = '{x}') > 0 THEN count(*) FILTER (WHERE sentiment = '{x}') / count(sentiment) ELSE 1.0::DOUBLE / 3 END AS {x}" for x in SENTIMENTS)
    + " FROM s_nw)",
    "nt AS (SELECT 'noticias' AS k, n / greatest(b, 1) AS n_por_lote, tr / n AS pct_trafico, "
    + ", ".join(f"{x} / (positivo + neutro + negativo) AS p_{x}" for x in SENTIMENTS) + " FROM nw)",
]
#: table -> (source in the SQL, key in Spark, numbers)
_PROFILES = {
    "perfil_hora": ("perfil", "concat(zona, '/', hora)", _LEARNED),
    "factor_dia": ("dia", "dia_semana", ["factor"]),
    "prob_nivel": ("nivel", "concat(zona, '/', hora)", ["p_alto", "p_medio", "p_bajo"]),
    "eventos": ("ev", "tipo", ["prob_evento", "prob_tipo"]),
    "noticias": ("nt", "'noticias'", ["n_por_lote", "pct_trafico", *[f"p_{x}" for x in SENTIMENTS]]),
}


@query(
    "profile_job",
    o.ctes(o.GOLD, *_PROFILE_CTES) + " UNION ALL ".join(_long_sql(t, src, "k", n) for t, (src, _, n) in _PROFILES.items()),
)
def _(spark, sf):
    """All five learned tables of the last week written, every one read back."""
    from citylake.catalog.products import cleaned, gold
    from citylake.plans.jobs import learn_profiles, materialise, write_profiles

    rows = materialise(gold(spark, sf), "profile-gold")
    parts = cleaned(spark, sf, "eventos", "redes_noticias")
    learned = learn_profiles(rows, parts["eventos"], parts["redes_noticias"], rows.agg(F.max("fecha")).scalar(), 6, days=7)
    path = shared_dir(spark, "profiles")
    write_profiles(learned, path)
    read = [_long(spark.read.parquet(f"{path}/{t}"), t, F.expr(key), n) for t, (_, key, n) in _PROFILES.items()]
    return reduce(DataFrame.unionByName, read)


_WINDOWS = [datetime.date(2024, 1, 14), datetime.date(2024, 1, 21), datetime.date(2024, 1, 30)]
_FROM_GOLD = {t: _PROFILES[t] for t in ("perfil_hora", "factor_dia", "prob_nivel")}


def _window_sql(end: datetime.date) -> str:
    near = f"p AS (SELECT * FROM gold WHERE fecha BETWEEN DATE '{end}' - 7 AND DATE '{end}')"
    rows = " UNION ALL ".join(_long_sql(t, src, "k", n, digits=6) for t, (src, _, n) in _FROM_GOLD.items())
    return f"SELECT '{end}' AS ventana, * FROM ({o.ctes(near, *_PROFILE_CTES[2:12])} {rows})"


@query("profile_sliding", o.ctes(o.GOLD) + " UNION ALL ".join(_window_sql(end) for end in _WINDOWS))
def _(spark, sf):
    """Profiles of three windows from the moments of one scan of gold."""
    from citylake.catalog.products import gold
    from citylake.plans.jobs import refresh_moments, sliding_profiles

    path = shared_dir(spark, "moments")
    refresh_moments(gold(spark, sf), path)
    moments, parts = spark.read.parquet(path), []
    for end in _WINDOWS:
        learned = sliding_profiles(moments, end)
        parts += [_long(learned[t], t, F.expr(key), n, digits=6).withColumn("ventana", F.lit(str(end))) for t, (_, key, n) in _FROM_GOLD.items()]
    return reduce(DataFrame.unionByName, parts)


# ---- written tables -------------------------------------------------------------------


@query("quality_report_stored", ORACLES["quality_report"])
def _(spark, sf):
    """The quality report of landed and cleaned files, counted without their data columns."""
    from citylake.operators.quality import stored_report
    from citylake.plans.silver import RULES, silver

    root, clean_root = _landed_sources(spark, sf), shared_dir(spark, "silver")
    extra = "event_id long, doc_id long"
    bronze = {n: rd.read_landed(spark, f"{root}/{n}", landed_schema(n, extra)) for n in SOURCE_ORDER}
    for name, rows in silver(bronze, SOURCE_ORDER).items():
        sk.overwrite_table(rows, f"{clean_root}/{name}")
    return stored_report(
        {n: (bronze[n], spark.read.parquet(f"{clean_root}/{n}"), RULES[n].report_field, SOURCE_QUALITY[n]) for n in bronze}
    )


@query("sorted_days", o.ctes(o.GOLD) + "SELECT count(*) AS filas, 0::BIGINT AS desordenadas, TRUE AS acotados FROM gold")
def _(spark, sf):
    """Gold written by day in order of zone and hour: no file has a row out of place or too many rows."""
    from citylake.catalog.products import gold

    path = shared_dir(spark, "sorted")
    sk.overwrite_days(gold(spark, sf), path, "fecha", ["zona", "hora"], most_rows=50)
    files = sk.order_in_files(spark.read.parquet(path), ["zona", "hora"])
    return files.agg(
        F.sum("rows").alias("filas"), F.sum("disordered").alias("desordenadas"), (F.max("rows") <= 50).alias("acotados")
    )


@query(
    "kpi_ml_export",
    " UNION ALL ".join(f"SELECT {o.q(n)} AS Modelo, 'ok' AS Estado, TRUE AS en_rango" for n in MODEL_NAMES),
)
def _(spark, sf):
    """The comparison of the nine classifiers among the exported KPI tables, read back from CSV."""
    from citylake.catalog.model_queries import compared
    from citylake.catalog.products import gold
    from citylake.plans.jobs import export_kpis, materialise

    path, (results, _, _) = shared_dir(spark, "kpis-ml"), compared(spark, sf)
    export_kpis(materialise(gold(spark, sf), "kpi-gold"), path, results)
    back = rd.read_csv(spark, f"{path}/kpi_ml_resultados", results.schema)
    share = reduce(lambda a, b: a & b, [F.col(m).between(0, 1) for m in _SCORES])
    return back.select("Modelo", "Estado", share.alias("en_rango"))


_LIMA = "(ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Lima'"


@query(
    "incremental_full",
    o.ctes(o.READINGS, o.SILVER_CLIMA)
    + f"""SELECT count(DISTINCT (zona, date_trunc('hour', {_LIMA}))) AS filas, TRUE AS como_completo, TRUE AS kpis_iguales, TRUE AS ensayo_sin_huella FROM s_cli""",
)
def _(spark, sf):
    """Refreshes in local time with a stored model, KPI export and a dry run, against a full
    build with the same model."""
    from citylake.catalog.products import cleaned
    from citylake.ml import models as md
    from citylake.ml import prep as pp
    from citylake.ml import store
    from citylake.plans.jobs import build_gold, kpi_tables, refresh_gold

    tz, model, root, kpis = "America/Lima", shared_dir(spark, "model"), shared_dir(spark, "gold"), shared_dir(spark, "kpis")
    bronze = _landed_sources(spark, sf)
    rows = build_gold(cleaned(spark, sf), shared_dir(spark, "gold"), _REFERENCE, storage=False, tz=tz)
    ready = pp.prepare(rows, "nivel_congestion")
    tree = next(c for c in md.candidates("nivel_congestion", ready.size, len(ready.selection.labels)) if c.name == "DecisionTree")
    store.save(ready, tree.estimator.fit(ready.train), tree.name, model)
    ready.release()

    def refresh(as_of, hours, **options):
        return refresh_gold(
            spark, bronze, root, list(SOURCE_ORDER), as_of, _REFERENCE, hours, relabel=lambda fresh: store.predict(fresh, model),
            order=SOURCE_ORDER, storage=False, tz=tz, extra="event_id long, doc_id long", **options,
        )

    # A local day begins five hours after the UTC day, so the first run starts a day earlier.
    for as_of, hours in [(datetime.datetime(2024, 1, 12, 23), 24 * 13), *_RUNS[1:]]:
        table_ = refresh(as_of, hours, kpis=kpis)

    def files():
        return sorted(r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path").collect())

    seen = files()
    refresh(*_RUNS[1], dry_run=True).write.format("noop").mode("overwrite").save()
    untouched = files() == seen
    want = store.predict(rows, model)
    columns = sorted(set(want.columns) & set(table_.columns))
    missing = want.select(*columns).exceptAll(table_.select(*columns)).agg(F.count(F.lit(1))).scalar()
    surplus = table_.select(*columns).exceptAll(want.select(*columns)).agg(F.count(F.lit(1))).scalar()
    exported = kpi_tables(want)["kpi_resumen"]
    same = exported.exceptAll(rd.read_csv(spark, f"{kpis}/kpi_resumen", exported.schema)).agg(F.count(F.lit(1))).scalar()
    return table_.agg(
        F.count(F.lit(1)).alias("filas"),
        ((missing == 0) & (surplus == 0)).alias("como_completo"),
        (same == 0).alias("kpis_iguales"),
        F.lit(untouched).alias("ensayo_sin_huella"),
    )
