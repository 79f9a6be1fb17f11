"""Gold table, advice, signals, KPI tables and measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from citylake.catalog import oracle as o
from citylake.catalog.registry import query
from citylake.catalog.views import SOURCE_ORDER, bronze_sources
from citylake.operators import kpi, measures
from citylake.operators.advise import route_advice, signal_timing
from citylake.operators.quality import null_report
from citylake.operators.rollup import strongest_events
from citylake.plans.gold import SCHEMA_GROUPS, congestion_by_zone
from citylake.plans.jobs import materialise
from citylake.plans.silver import silver, silver_report


def cleaned(spark, sf, *names):
    """Silver tables of the named sources, all six by default."""
    return silver(bronze_sources(spark, sf, list(names)), SOURCE_ORDER)


def gold(spark, sf):
    return congestion_by_zone(cleaned(spark, sf))


def stored(kpis):
    """A KPI table written once: the measures read it, not the plan behind it."""
    return materialise(kpis, "kpi")


@query("gold_wide", o.ctes(o.GOLD) + "SELECT * FROM gold")
def _(spark, sf):
    return gold(spark, sf)


@query("route_advice", o.ctes(o.GOLD, o.ADVICE) + "SELECT * FROM advice")
def _(spark, sf):
    return route_advice(gold(spark, sf))


@query("route_advice_useful", o.ctes(o.GOLD, o.ADVICE) + "SELECT * FROM advice WHERE estado = 'RECOMENDADA'")
def _(spark, sf):
    return route_advice(gold(spark, sf)).filter(F.col("estado") == "RECOMENDADA")


@query("signal_timing", o.ctes(o.GOLD, o.SIGNALS) + "SELECT * FROM signals")
def _(spark, sf):
    return signal_timing(gold(spark, sf))


def _silver_query(name: str, columns: dict[str, str], source: str):
    """Silver rows with their columns cast to plain types for comparison."""
    sql = o.ctes(o.SILVER) + f"SELECT {', '.join(columns.values())} FROM {source}"

    @query(f"silver_{name}", sql)
    def _(spark, sf):
        return cleaned(spark, sf, name)[name].selectExpr(*columns)


_TS = {"date_format(_ingest_ts, 'yyyy-MM-dd HH:mm') AS lote": "strftime(ingest_ts, '%Y-%m-%d %H:%M') AS lote"}
_DBL = lambda *cs: {f"CAST({c} AS DOUBLE) AS {c}": f"CAST({c} AS DOUBLE) AS {c}" for c in cs}
_INT = lambda *cs: {f"CAST({c} AS INT) AS {c}": f"CAST({c} AS INTEGER) AS {c}" for c in cs}
_RAW = lambda *cs: {c: c for c in cs}

_silver_query("clima", {**_RAW("event_id", "zona"), **_TS, **_DBL("temperatura_c", "humedad_pct", "precipitacion_mm", "viento_kmh"), **_INT("codigo_clima")}, "s_cli")
_silver_query("sensores_trafico", {**_RAW("event_id", "zona"), **_TS, **_DBL("congestion_ratio"), **_INT("intensidad_veh_hora")}, "s_sen")
_silver_query("gps_rutas", {**_RAW("event_id", "zona"), **_TS, **_DBL("congestion_factor", "velocidad_kmh"), **_INT("duracion_trafico_s")}, "s_gps")
_silver_query("vision_camaras", {**_RAW("event_id", "zona", "camara_id", "posicion"), **_TS, **_INT("total_detectado", "cnt_auto_taxi", "cnt_camion_hgv")}, "s_cam")
_silver_query("eventos", {**_RAW("nombre", "fecha", "zona_afectada", "tipo", "severidad"), **_DBL("impacto_factor"), **_INT("dias_para_evento")}, "s_ev")
_silver_query("redes_noticias", {**_RAW("item_id", "sentiment"), **_DBL("relevance_score"), "es_trafico": "coalesce(es_trafico, FALSE) AS es_trafico"}, "s_nw")

_REPORT = {
    "clima": ("r", "s_cli", "temperatura_c", "real"),
    "sensores_trafico": ("r", "s_sen", "congestion_ratio", "proxy"),
    "gps_rutas": ("r", "s_gps", "congestion_factor", "real"),
    "vision_camaras": ("cam0", "s_cam", "total_detectado", "calibrado"),
    "eventos": ("ev0", "s_ev", "impacto_factor", "real"),
    "redes_noticias": ("nw0", "s_nw", "relevance_score", "real"),
}


@query(
    "quality_report",
    o.ctes(
        o.SILVER,
        "q AS ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS fuente, '{key}' AS campo_clave, '{quality}' AS calidad_fuente, "
            f"(SELECT count(*) FROM {raw}) AS registros_bronze, (SELECT count(*) FROM {s}) AS registros_silver, "
            f"(SELECT count(*) FROM {s} WHERE {key} IS NULL) AS nulos_campo_clave"
            for n, (raw, s, key, quality) in _REPORT.items()
        )
        + ")",
    )
    + """SELECT *, registros_bronze - registros_silver AS descartados,
    coalesce(round_even(registros_silver * 100.0::DOUBLE / nullif(registros_bronze, 0), 1), 0.0::DOUBLE) AS pct_retenidos FROM q""",
)
def _(spark, sf):
    bronze = bronze_sources(spark, sf)
    return silver_report(bronze, silver(bronze, SOURCE_ORDER))


_GROUPED = [(g, c) for g, cols in SCHEMA_GROUPS.items() for c in cols]


@query(
    "null_report",
    o.ctes(o.GOLD)
    + " UNION ALL ".join(
        f"SELECT '{g}' AS grupo, '{c}' AS columna, count(*) FILTER (WHERE {c} IS NULL) AS nulos FROM gold" for g, c in _GROUPED
    ),
)
def _(spark, sf):
    return null_report(gold(spark, sf), SCHEMA_GROUPS)


@query("strongest_event", o.ctes(o.SILVER, o.EVENTS_DAILY) + "SELECT * FROM g_ev")
def _(spark, sf):
    return strongest_events(cleaned(spark, sf, "eventos")["eventos"].withColumn("impacto_factor", F.col("impacto_factor").cast("double")))


@query("kpi_global", o.ctes(o.GOLD, o.LATEST, o.KPI_GLOBAL) + "SELECT * FROM kpi_global")
def _(spark, sf):
    return kpi.global_kpis(gold(spark, sf))


@query("kpi_by_zone", o.ctes(o.GOLD, o.KPI_ZONE) + "SELECT * FROM kpi_zone")
def _(spark, sf):
    return kpi.zone_kpis(gold(spark, sf))


_LONG = [
    ("Velocidad promedio (km/h)", "CAST(round_even(velocidad_kmh, 1) AS VARCHAR)", "km/h"),
    ("Congestión global (ratio)", "CAST(round_even(congestion_ratio, 3) AS VARCHAR)", "ratio"),
    ("% Nivel ALTO", "CAST(round_even(pct_alto, 1) AS VARCHAR)", "%"),
    ("% Nivel MEDIO", "CAST(round_even(pct_medio, 1) AS VARCHAR)", "%"),
    ("% Nivel BAJO", "CAST(round_even(pct_bajo, 1) AS VARCHAR)", "%"),
    ("Nivel dominante", "nivel_dominante", "texto"),
    ("Velocidad mínima (km/h)", "CAST(round_even(vel_ultima, 1) AS VARCHAR)", "km/h"),
    ("Total vehiculos promedio", "CAST(round_even(total_vehiculos, 0) AS VARCHAR)", "veh"),
]


KPI_LONG_SQL = " UNION ALL ".join(f"SELECT zona, {o.q(n)} AS KPI, {v} AS Valor, '{u}' AS Unidad FROM kz" for n, v, u in _LONG)


@query(
    "kpi_long",
    o.ctes(o.GOLD, o.KPI_ZONE, o.LATEST, "kz AS (SELECT k.*, l.velocidad_kmh AS vel_ultima FROM kpi_zone k JOIN latest l USING (zona))")
    + KPI_LONG_SQL,
)
def _(spark, sf):
    return kpi.zone_kpis_long(gold(spark, sf))


@query("kpi_by_hour", o.ctes(o.GOLD, o.KPI_HOUR) + "SELECT * FROM kpi_hour")
def _(spark, sf):
    return kpi.hour_kpis(gold(spark, sf))


@query("kpi_composition", o.ctes(o.GOLD, o.KPI_COMPOSITION) + "SELECT * FROM kpi_composition")
def _(spark, sf):
    return kpi.composition_kpis(gold(spark, sf))


@query(
    "m_headline",
    o.ctes(
        o.GOLD, o.LATEST, o.KPI_GLOBAL,
        """h AS (SELECT CAST(max(Valor) FILTER (WHERE KPI = 'Velocidad promedio (km/h)') AS DOUBLE) AS velocidad_media,
    CAST(max(Valor) FILTER (WHERE KPI = 'Congestión global (ratio)') AS DOUBLE) AS congestion_ratio,
    CAST(max(Valor) FILTER (WHERE KPI = '% Nivel ALTO') AS DOUBLE) AS pct_alto,
    max(Valor) FILTER (WHERE KPI = 'Zona más congestionada') AS zona_critica FROM kpi_global)""",
        "h2 AS (SELECT *, CASE WHEN congestion_ratio < 0.40 THEN 'FLUIDO' WHEN congestion_ratio < 0.65 THEN 'MODERADO' ELSE 'CRÍTICO' END AS semaforo FROM h)",
    )
    + "SELECT *, CASE semaforo WHEN 'FLUIDO' THEN '#2ECC71' WHEN 'MODERADO' THEN '#F1C40F' ELSE '#E74C3C' END AS color, '● ' || semaforo AS icono FROM h2",
)
def _(spark, sf):
    return measures.headline(stored(kpi.global_kpis(gold(spark, sf))))


@query(
    "m_status",
    o.ctes(
        o.GOLD,
        "s AS (SELECT zona, fecha, hora, congestion_ratio, CASE WHEN congestion_ratio < 0.40 THEN 'FLUIDO' WHEN congestion_ratio < 0.65 THEN 'MODERADO' ELSE 'CRÍTICO' END AS semaforo, CASE WHEN congestion_ratio < 0.40 THEN 'FLUIDO' WHEN congestion_ratio < 0.70 THEN 'MODERADO' ELSE 'CRÍTICO' END AS semaforo_70 FROM gold WHERE congestion_ratio IS NOT NULL)",
    )
    + "SELECT *, CASE semaforo WHEN 'FLUIDO' THEN '#2ECC71' WHEN 'MODERADO' THEN '#F1C40F' ELSE '#E74C3C' END AS color, '● ' || semaforo AS icono FROM s",
)
def _(spark, sf):
    ratio = F.col("congestion_ratio")
    rows = gold(spark, sf).filter(ratio.isNotNull()).select("zona", "fecha", "hora", "congestion_ratio")
    labelled = rows.withColumns({"semaforo": measures.status(ratio), "semaforo_70": measures.status(ratio, 0.70)})
    label = F.col("semaforo")
    return labelled.withColumns({"color": measures.status_color(label), "icono": measures.status_icon(label)})


@query(
    "m_variation",
    o.ctes(
        o.GOLD, o.KPI_HOUR,
        "x AS (SELECT avg(velocidad_kmh) FILTER (WHERE hora = (SELECT max(hora) FROM kpi_hour)) AS velocidad_actual, avg(velocidad_kmh) FILTER (WHERE hora = (SELECT max(hora) - 1 FROM kpi_hour)) AS velocidad_hora_anterior FROM kpi_hour)",
    )
    + "SELECT *, coalesce((velocidad_actual - velocidad_hora_anterior) / nullif(velocidad_hora_anterior, 0), 0.0::DOUBLE) AS variacion_velocidad FROM x",
)
def _(spark, sf):
    return measures.speed_change(stored(kpi.hour_kpis(gold(spark, sf))))


@query(
    "m_peak_hour",
    o.ctes(o.GOLD, o.KPI_HOUR)
    + "SELECT max(hora_label) AS hora_pico FROM kpi_hour WHERE congestion_ratio = (SELECT max(congestion_ratio) FROM kpi_hour)",
)
def _(spark, sf):
    return measures.peak_hour(stored(kpi.hour_kpis(gold(spark, sf))))


@query(
    "m_offpeak",
    o.ctes(o.GOLD, o.KPI_HOUR)
    + "SELECT max(congestion_ratio) FILTER (WHERE es_hora_punta = 1) AS congestion_hora_pico, max(velocidad_kmh) FILTER (WHERE es_hora_punta = 0) AS velocidad_hora_valle FROM kpi_hour",
)
def _(spark, sf):
    return measures.peak_and_valley(stored(kpi.hour_kpis(gold(spark, sf))))


@query(
    "m_most_congested",
    o.ctes(o.GOLD, o.KPI_ZONE, "t AS (SELECT zona FROM kpi_zone WHERE congestion_ratio = (SELECT max(congestion_ratio) FROM kpi_zone))")
    + "SELECT CASE WHEN count(*) = 1 THEN max(zona) END AS zona_mas_congestionada FROM t",
)
def _(spark, sf):
    return measures.most_congested(stored(kpi.zone_kpis(gold(spark, sf))))


@query(
    "m_top3",
    o.ctes(o.GOLD, o.KPI_ZONE, "t AS (SELECT zona, congestion_ratio, rank() OVER (ORDER BY congestion_ratio DESC NULLS LAST) AS rk FROM kpi_zone)")
    + "SELECT string_agg(zona, ', ' ORDER BY congestion_ratio DESC, zona) AS top_zonas FROM t WHERE rk <= 3",
)
def _(spark, sf):
    return measures.top_zones(stored(kpi.zone_kpis(gold(spark, sf))))


@query(
    "m_zone_color",
    o.ctes(o.GOLD, o.KPI_ZONE)
    + "SELECT zona, nivel_dominante, CASE nivel_dominante WHEN 'alto' THEN '#E74C3C' WHEN 'medio' THEN '#F1C40F' ELSE '#2ECC71' END AS color_zona FROM kpi_zone",
)
def _(spark, sf):
    return measures.zone_colors(stored(kpi.zone_kpis(gold(spark, sf))))


@query(
    "m_dominant",
    o.ctes(o.GOLD, o.KPI_COMPOSITION)
    + "SELECT max(tipo_vehiculo) AS vehiculo_dominante FROM kpi_composition WHERE porcentaje = (SELECT max(porcentaje) FROM kpi_composition)",
)
def _(spark, sf):
    return measures.dominant_vehicle(stored(kpi.composition_kpis(gold(spark, sf))))


@query(
    "m_slicers",
    o.ctes(o.GOLD)
    + "SELECT zona, fecha, hora, nivel_congestion, indice_congestion FROM gold WHERE zona IN ('Via Expresa - Centro', 'Costa Verde - Miraflores') AND nivel_congestion IN ('alto', 'medio') AND es_hora_punta = 1",
)
def _(spark, sf):
    rows = measures.slice_rows(
        gold(spark, sf), ["Via Expresa - Centro", "Costa Verde - Miraflores"], ["alto", "medio"], True
    )
    return rows.select("zona", "fecha", "hora", "nivel_congestion", "indice_congestion")
