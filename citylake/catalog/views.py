"""The six city sources as views of the test tables, in Spark and in SQL.

Readings come from `events`, city events from `orders`, news from `documents`.
The measured value is snapped to 1/64 steps, the resolution of the imagined
sensor, so that sums of readings are exact in double arithmetic and an average
does not depend on the order in which an engine adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.dims import VEHICLE_SHARES, ZONE_NAMES
from citylake.functions.numeric import proportional_counts
from citylake.functions.text import add_scores
from citylake.functions.timegrain import add_time_grain, batch_start
from citylake.functions.traffic import camera_id, service_level

FIRST_DAY = "2024-01-01"
LAST_DAY = "2024-01-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(index, names: list[str]):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    v = F.floor(F.col("value") * 64) / F.lit(64.0)
    base = e.select(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        batch_start("ts").alias("_ingest_ts"),
        pick(F.col("user_id") % 6, ZONE_NAMES).alias("zona"),
        F.when(F.col("event_id") % 2 == 0, "entrada").otherwise("salida").alias("posicion"),
        k.alias("k"),
        v.alias("v"),
    )
    v, k = F.col("v"), F.col("k")
    measured = base.withColumns(
        {
            "temperatura_c": F.when(k % 7 != 0, v / 16 + 15),
            "humedad_pct": k / F.lit(2.0) + 40,
            "precipitacion_mm": F.greatest(v / 32 - 1, F.lit(0.0)),
            "viento_kmh": k / F.lit(4.0),
            "codigo_clima": (k % 4 * 15).cast("int"),
            "congestion_ratio": F.when(k % 13 != 0, v / 256),
            "intensidad_veh_hora": F.floor(v * 10).cast("double"),
            "congestion_factor": F.when(k % 11 != 0, v / 128 + 1),
            "velocidad_kmh": 130 - v / 4,
            "duracion_trafico_s": F.floor(v * 8).cast("double") + 300,
            "total_detectado": k,
        }
    )
    return add_time_grain(measured, "ts")


_KEY = ["event_id", "zona", "_ingest_ts"]


def _quality(label: str):
    return F.lit(label).alias("_calidad_fuente")


def _clima(spark, sf_dir):
    metrics = ["temperatura_c", "humedad_pct", "precipitacion_mm", "viento_kmh", "codigo_clima"]
    return readings(spark, sf_dir).select(*_KEY, *metrics, _quality("real"))


def _sensores(spark, sf_dir):
    level = service_level(F.col("congestion_ratio")).alias("nivel_servicio")
    return readings(spark, sf_dir).select(*_KEY, "congestion_ratio", "intensidad_veh_hora", level, _quality("proxy"))


def _gps(spark, sf_dir):
    metrics = ["congestion_factor", "velocidad_kmh", "duracion_trafico_s"]
    return readings(spark, sf_dir).select(*_KEY, *metrics, _quality("real"))


def _camaras(spark, sf_dir):
    side = F.when(F.col("posicion") == "entrada", 1).otherwise(2)
    return readings(spark, sf_dir).select(
        *_KEY,
        camera_id(F.col("zona"), side).alias("camara_id"),
        "posicion",
        "total_detectado",
        *proportional_counts("total_detectado", VEHICLE_SHARES),
        _quality("calibrado"),
    )


def city_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as city events: one in three is city-wide, some name no known zone."""
    o = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.date_add(F.lit(FIRST_DAY).cast("date"), (key % 30).cast("int")).alias("fecha"),
        F.concat(F.lit("evento "), key.cast("string")).alias("nombre"),
        F.when(F.col("o_orderstatus") == "F", "todas").otherwise(pick(cust % 7, [*ZONE_NAMES, "ninguna"])).alias("zona_afectada"),
        pick(key % 4, ["feriado", "concierto", "futbol", "feriado_oficial"]).alias("tipo"),
        F.when(key % 5 != 0, pick(cust % 3, ["alta", "media", "baja"])).alias("severidad"),
        (F.lit(1.0) + (key % 80) / F.lit(64.0)).alias("impacto_factor"),
        (key % 8).cast("int").alias("dias_para_evento"),
        F.to_timestamp(F.lit(FIRST_DAY)).alias("_ingest_ts"),
        F.lit("real").alias("_calidad_fuente"),
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as news items, scored over their whole text."""
    d = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    stamp = F.timestamp_seconds(
        F.unix_seconds(F.to_timestamp(F.lit(FIRST_DAY))) + (doc % 30) * 86400 + (doc % 24) * 3600
    )
    scored = add_scores(d, "text")
    return scored.select(
        F.substring(F.md5(F.concat(F.col("source"), F.lit("/"), (doc - doc % 2).cast("string")).cast("binary")), 1, 12).alias("item_id"),
        "doc_id",
        F.substring("text", 1, 200).alias("titulo"),
        "relevance_score",
        "sentiment",
        F.when(doc % 9 != 0, F.col("es_trafico")).alias("es_trafico"),
        stamp.alias("_ingest_ts"),
        F.lit("real").alias("_calidad_fuente"),
    )


SOURCES = {
    "clima": _clima,
    "sensores_trafico": _sensores,
    "gps_rutas": _gps,
    "vision_camaras": _camaras,
    "eventos": city_events,
    "redes_noticias": news,
}


def bronze_sources(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    return {n: SOURCES[n](spark, sf_dir) for n in names or SOURCES}


SOURCE_ORDER = {
    "clima": ["event_id"],
    "sensores_trafico": ["event_id"],
    "gps_rutas": ["event_id"],
    "vision_camaras": ["event_id"],
    "eventos": ["nombre"],
    "redes_noticias": ["doc_id"],
}
