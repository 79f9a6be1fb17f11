"""Cleaning rules of the six sources."""

from __future__ import annotations

from pyspark.sql import DataFrame

from citylake.operators.quality import CleanRule, clean, quality_report
from citylake.sources.sinks import overwrite_table

RULES = {
    "clima": CleanRule(
        required=("temperatura_c", "humedad_pct", "zona"),
        key=("zona", "_ingest_ts"),
        casts={"temperatura_c": "float", "humedad_pct": "float", "precipitacion_mm": "float", "viento_kmh": "float", "codigo_clima": "smallint"},
        sort=("zona", "_ingest_ts"),
        report_field="temperatura_c",
    ),
    "sensores_trafico": CleanRule(
        required=("congestion_ratio", "zona"),
        key=("zona", "_ingest_ts"),
        integers={"intensidad_veh_hora": "int", "capacidad_veh_hora": "int", "sensores_activos": "int"},
        casts={"congestion_ratio": "float", "ocupacion_pct": "float", "carga_pct": "float"},
        ranges={"congestion_ratio": (0, 1)},
        sort=("zona", "_ingest_ts"),
        report_field="congestion_ratio",
    ),
    "gps_rutas": CleanRule(
        required=("velocidad_kmh", "congestion_factor", "zona"),
        key=("zona", "_ingest_ts"),
        integers={"distancia_m": "int", "duracion_libre_s": "int", "duracion_trafico_s": "int"},
        casts={"velocidad_kmh": "float", "congestion_factor": "float"},
        ranges={"velocidad_kmh": (1, 130), "congestion_factor": (1.0, 5.0)},
        sort=("zona", "_ingest_ts"),
        report_field="congestion_factor",
    ),
    "vision_camaras": CleanRule(
        required=("total_detectado", "zona", "camara_id"),
        key=("camara_id", "_ingest_ts"),
        casts={"total_detectado": "int", "hora_local": "tinyint"},
        ranges={"total_detectado": (0, None)},
        sort=("zona", "camara_id", "_ingest_ts"),
        report_field="total_detectado",
    ),
    "eventos": CleanRule(
        required=("nombre", "fecha", "impacto_factor"),
        key=("nombre", "fecha"),
        integers={"dias_para_evento": "smallint"},
        casts={"impacto_factor": "float"},
        ranges={"impacto_factor": (1.0, 2.0)},
        sort=("fecha", "nombre"),
        report_field="impacto_factor",
    ),
    "redes_noticias": CleanRule(
        required=("titulo", "relevance_score"),
        key=("item_id",),
        casts={"relevance_score": "float"},
        flags=("es_trafico",),
        ranges={"relevance_score": (0, 1)},
        sort=("_ingest_ts", "relevance_score"),
        report_field="relevance_score",
    ),
}


def silver(
    bronze: dict[str, DataFrame], order: dict[str, list[str]] | None = None, storage: bool = False
) -> dict[str, DataFrame]:
    """Clean every source that was read."""
    order = order or {}
    return {name: clean(df, RULES[name], order.get(name), storage) for name, df in bronze.items()}


def write_silver(bronze: dict[str, DataFrame], path: str) -> None:
    for name, table in silver(bronze, storage=True).items():
        overwrite_table(table, f"{path}/{name}", [c for c in RULES[name].sort if c in table.columns])


def silver_report(bronze: dict[str, DataFrame], cleaned: dict[str, DataFrame]) -> DataFrame:
    return quality_report({n: (bronze[n], cleaned[n], RULES[n].report_field) for n in bronze})
