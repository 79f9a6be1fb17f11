"""Fixed values of the domain: zones, lookups, thresholds, word lists.

Everything here is a constant that results depend on; behaviour lives elsewhere.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Zone(NamedTuple):
    name: str
    lat: float
    lon: float
    corridor: str
    free_speed: float
    capacity: int


# ---- fixed values -----------------------------------------------------------

ZONES = [
    Zone("Via Expresa - Centro", -12.071, -77.033, "via_expresa", 80.0, 85),
    Zone("Javier Prado - San Isidro", -12.092, -77.022, "arteria_principal", 60.0, 60),
    Zone("Panamericana Norte - Independencia", -11.990, -77.060, "acceso_autopista", 80.0, 75),
    Zone("Carretera Central - Ate", -12.030, -76.920, "acceso_autopista", 80.0, 75),
    Zone("Av. Brasil - Magdalena", -12.090, -77.060, "avenida", 40.0, 35),
    Zone("Costa Verde - Miraflores", -12.130, -77.030, "via_periferica", 70.0, 90),
]

# Alternative corridors per zone, best-known first.
ALTERNATIVES = {
    "Via Expresa - Centro": ["Javier Prado - San Isidro", "Av. Brasil - Magdalena"],
    "Javier Prado - San Isidro": ["Via Expresa - Centro", "Carretera Central - Ate"],
    "Panamericana Norte - Independencia": ["Via Expresa - Centro", "Av. Brasil - Magdalena"],
    "Carretera Central - Ate": ["Javier Prado - San Isidro", "Via Expresa - Centro"],
    "Av. Brasil - Magdalena": ["Costa Verde - Miraflores", "Via Expresa - Centro"],
    "Costa Verde - Miraflores": ["Av. Brasil - Magdalena", "Via Expresa - Centro"],
}

# Loop-detector ids per zone.
DETECTORS = {
    "Via Expresa - Centro": ["5423", "5520"],
    "Javier Prado - San Isidro": ["5451", "5452", "5453"],
    "Panamericana Norte - Independencia": ["5429", "10463"],
    "Carretera Central - Ate": ["5486", "9991"],
    "Av. Brasil - Magdalena": ["5641", "5011", "10572"],
    "Costa Verde - Miraflores": ["4823", "4824", "4822"],
}

SERVICE_LABELS = {
    "0": "Fluido",
    "1": "Lento",
    "2": "Retenido",
    "3": "Cortado",
    "-1": "Sin datos",
}

SOURCE_QUALITY = {
    "clima": "real",
    "sensores_trafico": "proxy",
    "gps_rutas": "real",
    "vision_camaras": "calibrado",
    "eventos": "real",
    "redes_noticias": "real",
}

SEVERITY_FACTOR = {"alta": 1.45, "media": 1.20, "baja": 1.08}

HOLIDAY_TYPES = ["feriado_oficial", "feriado", "feriado_especial"]

# Vehicle mix; the last class absorbs rounding.
VEHICLE_SHARES = {
    "auto_taxi": 0.55,
    "combi_minibus": 0.20,
    "moto_mototaxi": 0.12,
    "bus": 0.05,
    "camioneta_lgv": 0.06,
    "camion_hgv": 0.02,
}

VEHICLE_LABELS = {
    "auto_taxi": "Auto/Taxi",
    "combi_minibus": "Combi/Minibus",
    "moto_mototaxi": "Moto/Mototaxi",
    "bus": "Bus",
    "camioneta_lgv": "Camioneta/LGV",
    "camion_hgv": "Camion/HGV",
}

PEAK_HOURS = [7, 8, 9, 17, 18, 19]

SERVICE_CUTS = [(0.30, "A"), (0.50, "B"), (0.65, "C"), (0.80, "D"), (0.95, "E")]

MONTH_FACTOR = [1.00, 1.00, 1.02, 1.00, 1.06, 1.10, 1.12, 1.12, 1.10, 1.08, 1.02, 1.00]
YEARLY_GROWTH = 0.035
REFERENCE_YEAR = 2026

EVENT_TYPES = ["deportivo", "cultural", "accidente", "obras", "marcha", "feriado"]
SENTIMENTS = ["positivo", "neutro", "negativo"]

TRAFFIC_WORDS = [
    "tráfico", "trafico", "tránsito", "transito", "congestión", "congestion",
    "accidente", "choque", "colisión", "colision", "atropello",
    "vía", "via", "avenida", "carretera", "autopista", "pista",
    "desvío", "desvio", "cierre vial", "obra vial", "bloqueo",
    "manifestación", "manifestacion", "marcha", "protesta", "paro",
    "panamericana", "javier prado", "vía expresa", "via expresa",
    "costa verde", "av. brasil", "carretera central",
]
NEGATIVE_WORDS = [
    "accidente", "choque", "colisión", "atropello", "bloqueo",
    "congestión", "congestion", "cierre", "interrupción", "caos",
]
POSITIVE_WORDS = [
    "mejora", "habilitó", "apertura", "fluidez", "solución",
    "nuevo acceso", "ampliación",
]

GREEN_BASE, GREEN_MIN, GREEN_MAX = 60, 30, 120
SIGNAL_IMPACT = {
    "ampliar_verde": "Reduce cola entrada ~15-25%",
    "reducir_verde": "Libera salida, mejora fluidez",
    "mantener": "Flujo equilibrado",
}

STATUS_COLOR = {"FLUIDO": "#2ECC71", "MODERADO": "#F1C40F", "CRÍTICO": "#E74C3C"}
LEVEL_COLOR = {"bajo": "#2ECC71", "medio": "#F1C40F", "alto": "#E74C3C"}

# ---- end of fixed values ----------------------------------------------------

ZONE_NAMES = [z.name for z in ZONES]
FREE_SPEED = {z.name: z.free_speed for z in ZONES}
CAPACITY = {z.name: z.capacity for z in ZONES}


def sql_literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, float):
        return f"{value!r}D"
    return str(value)


def values_frame(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """Literal rows as a local relation: its size is known to the optimizer, so a
    join with it is broadcast by the threshold rule and needs no hint."""
    body = ", ".join("(" + ", ".join(map(sql_literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def zone_frame(spark: SparkSession) -> DataFrame:
    return values_frame(
        spark,
        [tuple(z) for z in ZONES],
        ["zona", "lat", "lon", "tipo_corredor", "vel_libre", "capacidad"],
    )


def detector_frame(spark: SparkSession) -> DataFrame:
    rows = [(sensor, zone) for zone, sensors in DETECTORS.items() for sensor in sensors]
    return values_frame(spark, rows, ["sensor_id", "zona"])
