"""Readings to hourly facts per zone.

All roll-ups group on the same key, so their outputs are partitioned alike and
the gold joins need no further exchange. Partial aggregation runs before every
shuffle: a zone holding a third of the readings ships one row per hour and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.dims import HOLIDAY_TYPES, SERVICE_LABELS, VEHICLE_SHARES, ZONE_NAMES
from citylake.functions.numeric import lookup, np_round
from citylake.operators.quality import first_row

HOUR_KEY = ["zona", "fecha", "hora"]


def _avg(c: str) -> Column:
    return F.avg(F.col(c).cast("double"))


def hourly(df: DataFrame, means: list[str], modes: list[str] = (), digits: int = 3, key: list[str] = HOUR_KEY) -> DataFrame:
    """Rounded means and smallest most frequent values.

    `modes` is for code columns with few values: its buffer holds one counter per
    distinct value.
    """
    return df.groupBy(*key).agg(
        *[np_round(_avg(c), digits).alias(c) for c in means],
        *[F.mode(c, True).alias(c) for c in modes],
    )


def weather_hourly(silver: DataFrame) -> DataFrame:
    """The weekday follows from the date; grouping on it too would partition this
    table differently from the others and cost the joins an extra shuffle."""
    means = ["temperatura_c", "humedad_pct", "precipitacion_mm", "viento_kmh"]
    return hourly(silver, means, ["codigo_clima"], digits=2).withColumn("dia_semana", F.weekday("fecha"))


def sensors_hourly(silver: DataFrame) -> DataFrame:
    return hourly(silver, ["congestion_ratio", "intensidad_veh_hora"], ["nivel_servicio"])


def gps_hourly(silver: DataFrame) -> DataFrame:
    return hourly(silver, ["congestion_factor", "velocidad_kmh", "duracion_trafico_s"])


def camera_sums(counts: list[str]) -> list[Column]:
    """Sums over the cameras of one batch, with both directions in the same pass."""

    def flow(side: str) -> Column:
        return F.sum(F.when(F.col("posicion") == side, F.col("total_detectado")))

    return [
        *[F.sum(c).alias(c) for c in ["total_detectado", *counts]],
        flow("entrada").alias("v_entrada"),
        flow("salida").alias("v_salida"),
        F.count_if(F.col("posicion").isin("entrada", "salida")).alias("n_directed"),
    ]


def camera_means(counts: list[str]) -> list[Column]:
    """Means over the batches of an hour; an absent direction counts as 0 in batches that
    saw the other one."""

    def directed_mean(c: str) -> Column:
        return np_round(F.avg(F.when(F.col("n_directed") > 0, F.coalesce(F.col(c), F.lit(0)))), 1)

    return [
        *[np_round(_avg(c), 1).alias(c) for c in ["total_detectado", *counts]],
        directed_mean("v_entrada").alias("vehiculos_entrada"),
        directed_mean("v_salida").alias("vehiculos_salida"),
    ]


def camera_counts(silver: DataFrame) -> list[str]:
    return [c for c in silver.columns if c.startswith("cnt_")]


def cameras_hourly(silver: DataFrame, batch: str = "_ingest_ts") -> DataFrame:
    """Vehicles per zone and hour, class shares and directional flow.

    Batches sum, hours average. One scan replaces separate composition, inflow and
    outflow passes with an outer join.
    """
    counts = camera_counts(silver)
    batches = silver.groupBy(*HOUR_KEY, batch).agg(*camera_sums(counts))
    means = batches.groupBy(*HOUR_KEY).agg(*camera_means(counts))
    return class_shares(means.withColumnRenamed("total_detectado", "total_vehiculos_zona"), counts)


def class_shares(df: DataFrame, counts: list[str]) -> DataFrame:
    """Counts to percentages of their row total (no vehicles, no shares); counts are dropped."""
    present = [F.coalesce(F.col(c), F.lit(0.0)) for c in counts]
    total = sum(present[1:], present[0])
    shares = {
        "pct_" + c.removeprefix("cnt_"): np_round(F.try_divide(F.col(c), F.nullif(F.col("_total"), F.lit(0.0))) * 100, 1)
        for c in counts
    }
    out = df.withColumn("_total", total).withColumns(shares).drop("_total", *counts)
    parts = [F.col(c) if c in shares else F.lit(0.0) for c in ("pct_bus", "pct_combi_minibus")]
    return out.withColumn("pct_transporte_publico", np_round(parts[0] + parts[1], 1))


def to_every_zone(events: DataFrame, zones: list[str] = ZONE_NAMES, everywhere: str = "todas") -> DataFrame:
    """City-wide events once per zone; events naming one zone, known or not, stay as they are."""
    city_wide = F.array(*[F.lit(z) for z in zones])
    target = F.when(F.col("zona_afectada") == everywhere, city_wide).otherwise(F.array("zona_afectada"))
    return events.withColumn("zona_afectada", F.explode(target))


def strongest_events(events: DataFrame, zones: list[str] = ZONE_NAMES, everywhere: str = "todas") -> DataFrame:
    """The event with most impact per zone and day, as one whole row.

    City-wide events are reduced to one per day before they are copied to every
    zone: the strongest of all is the strongest of the strongest.
    """
    kept = ["zona_afectada", "fecha", "impacto_factor", "nombre", "tipo", "severidad"]
    order = [F.desc("impacto_factor"), "nombre", "tipo", "severidad"]

    def winners(df: DataFrame) -> DataFrame:
        return first_row(df.select(*kept), ["zona_afectada", "fecha"], order)

    return winners(to_every_zone(winners(events), zones, everywhere)).select(
        F.col("zona_afectada").alias("zona"),
        "fecha",
        F.col("impacto_factor").alias("impacto_factor_evento"),
        F.col("tipo").alias("tipo_evento"),
        "severidad",
        F.lit(True).alias("tiene_evento"),
        F.coalesce(F.col("tipo").isin(HOLIDAY_TYPES), F.lit(False)).alias("es_feriado"),
    )


def news_hourly(silver: DataFrame) -> DataFrame:
    """City-wide counters: news carries no zone."""
    return silver.groupBy("fecha", "hora").agg(
        F.count_if(F.col("es_trafico")).cast("int").alias("noticias_trafico_cnt"),
        F.count_if(F.col("sentiment") == "negativo").cast("int").alias("sentimiento_negativo_cnt"),
        F.max("relevance_score").alias("relevance_score_max"),
    )


def detector_clusters(readings: DataFrame, detectors: DataFrame, *extra: str) -> DataFrame:
    """Detector readings to one row per zone (and any extra key).

    The inner join with the id list keeps listed detectors only; detectors in
    error or without data are left out, and a zone with none left disappears.
    """
    key = ["zona", *extra]
    valid = readings.filter((F.col("error") == "N") & (F.col("nivel") != "-1")).join(detectors, "sensor_id")
    mean = valid.groupBy(*key).agg(
        *[F.avg(c).alias(c) for c in ("intensidad", "ocupacion", "carga", "saturacion")],
        F.max(F.col("nivel").try_cast("int")).alias("nivel"),
        F.count(F.lit(1)).alias("sensores_activos"),
    )
    level = F.coalesce(F.col("nivel").cast("string"), F.lit("-1"))
    ratio = F.when(
        F.col("saturacion") > 0, np_round(F.try_divide(F.col("intensidad"), F.col("saturacion")), 3)
    ).otherwise(F.lit(0.0))
    return mean.select(
        *key,
        np_round("intensidad").cast("int").alias("intensidad_veh_hora"),
        np_round("ocupacion", 1).alias("ocupacion_pct"),
        np_round("carga", 1).alias("carga_pct"),
        np_round("saturacion").cast("int").alias("capacidad_veh_hora"),
        ratio.alias("congestion_ratio"),
        level.alias("nivel_servicio"),
        lookup(level, SERVICE_LABELS, "Desconocido").alias("nivel_label"),
        F.col("sensores_activos").cast("int").alias("sensores_activos"),
    ).filter(F.col("congestion_ratio").between(0, 1) & (F.col("intensidad_veh_hora") >= 0))


def vehicle_counts() -> list[str]:
    return ["cnt_" + name for name in VEHICLE_SHARES]
