"""Dashboard measures over KPI tables, one-row results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.dims import LEVEL_COLOR, STATUS_COLOR
from citylake.functions.numeric import lookup


def kpi_text(kpi: str) -> Column:
    """Aggregate: the KPI's value, blank unless it is unique."""
    hit = F.when(F.col("KPI") == kpi, F.col("Valor"))
    return F.when(F.countDistinct(hit) == 1, F.max(hit))


def kpi_number(kpi: str) -> Column:
    return kpi_text(kpi).try_cast("double")


def status(ratio: Column, amber: float = 0.65) -> Column:
    return F.when(ratio < 0.40, "FLUIDO").when(ratio < amber, "MODERADO").otherwise("CRÍTICO")


def status_color(label: Column) -> Column:
    return lookup(label, STATUS_COLOR, STATUS_COLOR["CRÍTICO"])


def status_icon(label: Column) -> Column:
    return F.concat(F.lit("● "), label)


def level_color(level: Column) -> Column:
    return lookup(level, LEVEL_COLOR, LEVEL_COLOR["bajo"])


def score_color(f1: Column) -> Column:
    return F.when(f1 >= 0.88, LEVEL_COLOR["bajo"]).when(f1 >= 0.85, LEVEL_COLOR["medio"]).otherwise(LEVEL_COLOR["alto"])


def headline(kpis: DataFrame) -> DataFrame:
    ratio = F.col("congestion_ratio")
    return kpis.agg(
        kpi_number("Velocidad promedio (km/h)").alias("velocidad_media"),
        kpi_number("Congestión global (ratio)").alias("congestion_ratio"),
        kpi_number("% Nivel ALTO").alias("pct_alto"),
        kpi_text("Zona más congestionada").alias("zona_critica"),
    ).withColumn("semaforo", status(ratio)).withColumns(
        {"color": status_color(F.col("semaforo")), "icono": status_icon(F.col("semaforo"))}
    )


def speed_change(series: DataFrame) -> DataFrame:
    """Speed at the last hour of the series, at the hour before, and the change.

    The last hour is a scalar subquery over the 24-row series.
    """
    last = series.agg(F.max("hora")).scalar()
    now, before = F.col("velocidad_actual"), F.col("velocidad_hora_anterior")
    return series.agg(
        F.avg(F.when(F.col("hora") == last, F.col("velocidad_kmh"))).alias("velocidad_actual"),
        F.avg(F.when(F.col("hora") == last - 1, F.col("velocidad_kmh"))).alias("velocidad_hora_anterior"),
    ).withColumn("variacion_velocidad", F.coalesce(F.try_divide(now - before, before), F.lit(0.0)))


def top_with_ties(df: DataFrame, by: str, n: int) -> DataFrame:
    """The n largest rows and everything that ties with the last of them.

    The cut-off value is a top-n over the whole table (n rows per task at most);
    the rows are then kept by a plain filter, so any number of ties stays spread
    over the tasks that hold them. NULLs rank last.
    """
    nth = df.orderBy(F.col(by).desc_nulls_last()).limit(n).agg(
        F.struct(F.min(by).alias("cut"), (F.count(F.lit(1)) > F.count(by)).alias("blanks")).alias("nth")
    ).scalar()
    return df.filter((F.col(by) >= nth["cut"]) | (nth["blanks"] & F.col(by).isNull()))


def peak_hour(series: DataFrame) -> DataFrame:
    return top_with_ties(series, "congestion_ratio", 1).agg(F.max("hora_label").alias("hora_pico"))


def peak_and_valley(series: DataFrame) -> DataFrame:
    return series.agg(
        F.max(F.when(F.col("es_hora_punta") == 1, F.col("congestion_ratio"))).alias("congestion_hora_pico"),
        F.max(F.when(F.col("es_hora_punta") == 0, F.col("velocidad_kmh"))).alias("velocidad_hora_valle"),
    )


def most_congested(zones: DataFrame) -> DataFrame:
    """Blank when several zones share the maximum."""
    return top_with_ties(zones, "congestion_ratio", 1).agg(
        F.when(F.countDistinct("zona") == 1, F.max("zona")).alias("zona_mas_congestionada")
    )


def top_zones(zones: DataFrame, n: int = 3) -> DataFrame:
    ordered = F.expr("listagg(zona, ', ') WITHIN GROUP (ORDER BY congestion_ratio DESC, zona ASC)")
    return top_with_ties(zones, "congestion_ratio", n).agg(ordered.alias("top_zonas"))


def zone_colors(zones: DataFrame) -> DataFrame:
    return zones.select("zona", "nivel_dominante", level_color(F.col("nivel_dominante")).alias("color_zona"))


def best_model(results: DataFrame) -> DataFrame:
    best = F.col("es_mejor") == 1
    return results.agg(
        F.when(F.countDistinct(F.when(best, F.col("Modelo"))) == 1, F.max(F.when(best, F.col("Modelo")))).alias("mejor_modelo"),
        F.max(F.when(best, F.col("F1_score"))).alias("mejor_f1"),
    ).withColumn("color_ml", score_color(F.col("mejor_f1")))


def dominant_vehicle(composition: DataFrame) -> DataFrame:
    return top_with_ties(composition, "porcentaje", 1).agg(F.max("tipo_vehiculo").alias("vehiculo_dominante"))


def slice_rows(df: DataFrame, zones: list[str] | None = None, levels: list[str] | None = None, peak: bool | None = None) -> DataFrame:
    """Slicers: unset ones do not filter."""
    if zones is not None:
        df = df.filter(F.col("zona").isin(zones))
    if levels is not None:
        df = df.filter(F.col("nivel_congestion").isin(levels))
    if peak is not None:
        df = df.filter(F.col("es_hora_punta").cast("int") == int(peak))
    return df
