"""Dashboard KPI tables from the gold table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.dims import VEHICLE_LABELS, ZONES
from citylake.functions.numeric import lookup, np_round
from citylake.functions.timegrain import hour_label, is_peak
from citylake.operators.quality import with_defaults

LEVELS = ["alto", "medio", "bajo"]


def text(c: Column) -> Column:
    return c.cast("string")


def _row(kpi: str, value: Column, unit: str) -> Column:
    return F.struct(F.lit(kpi).alias("KPI"), value.alias("Valor"), F.lit(unit).alias("Unidad"))


#: Decimals of the metrics that are averaged; their sums are kept as scaled integers.
DIGITS = {
    "velocidad_kmh": 3,
    "congestion_ratio": 3,
    "intensidad_veh_hora": 3,
    "total_vehiculos_zona": 1,
    **{f"pct_{k}": 1 for k in VEHICLE_LABELS},
}
NEWEST = {"newest_ratio": "congestion_ratio", "newest_speed": "velocidad_kmh"}


def sum_columns(gold: DataFrame) -> list[Column]:
    """Counts and sums from which all KPI tables follow, for the columns the table has."""
    out = [F.count(F.lit(1)).alias("n")]
    for c, digits in DIGITS.items():
        if c in gold.columns:
            out += [F.sum(F.rint(F.col(c) * float(10**digits)).cast("bigint")).alias(f"s_{c}"), F.count(c).alias(f"n_{c}")]
    if "nivel_congestion" in gold.columns:
        out += [F.count_if(F.col("nivel_congestion") == v).alias(f"n_{v}") for v in LEVELS]
    if "tiene_evento" in gold.columns:
        out.append(F.sum(F.col("tiene_evento").cast("int")).alias("events"))
    return out


def newest_columns() -> list[Column]:
    """The latest hour and its values; a later partial replaces them as a whole. One number
    as order keeps the aggregation in a hash table."""
    hour = F.unix_date(F.col("fecha").cast("date")) * 24 + F.col("hora").cast("int")
    return [F.max(hour).alias("newest"), *[F.max_by(c, hour).alias(name) for name, c in NEWEST.items()]]


def day_partials(gold: DataFrame) -> DataFrame:
    """Sums per day and zone, and per day and hour, from one scan; `by_hour` tells them apart."""
    return gold.groupingSets([["fecha", "zona"], ["fecha", "hora"]], "fecha", "zona", "hora").agg(
        F.grouping("zona").alias("by_hour"), *sum_columns(gold), *newest_columns()
    )


def merged(partials: DataFrame, key: str) -> DataFrame:
    """Partials of many days to one row per zone or hour, as the sums of the whole table."""
    rows = partials.filter(F.col("by_hour") == (1 if key == "hora" else 0))
    summed = [F.sum(c).alias(c) for c in rows.columns if c in ("n", "events") or c.startswith(("s_", "n_"))]
    kept = [F.max_by(c, "newest").alias(c) for c in NEWEST]
    return rows.groupBy(key).agg(*summed, *(kept if key == "zona" else []))


def mean_of(c: str, total=F.col) -> Column:
    """Mean of a metric from its sums; `total` may add them up first."""
    return F.try_divide(total(f"s_{c}").cast("double"), (total(f"n_{c}") * 10 ** DIGITS[c]).cast("double"))


def level_share(v: str, total=F.col) -> Column:
    return total(f"n_{v}").cast("double") / total("n").cast("double") * 100.0


def zone_sums(gold: DataFrame) -> DataFrame:
    return gold.groupBy("zona").agg(*sum_columns(gold), *newest_columns())


def global_kpis(gold: DataFrame) -> DataFrame:
    """Eight headline rows.

    One pass: sums per zone, then over zones. The newest row of each zone rides
    along in the same aggregation. Tables without zone or event columns get the
    documented fallbacks.
    """
    zoned = "zona" in gold.columns
    gold = with_defaults(gold, {c: v for c, v in {"zona": "N/D", "tiene_evento": 0}.items() if c not in gold.columns})
    return global_table(zone_sums(gold), zoned)


def global_table(per_zone: DataFrame, zoned: bool = True) -> DataFrame:
    total = per_zone.agg(
        *[mean_of(c, F.sum).alias(c) for c in ("velocidad_kmh", "congestion_ratio")],
        *[level_share(v, F.sum).alias(f"pct_{v}") for v in LEVELS],
        F.min_by("zona", F.when(F.col("newest_ratio").isNotNull(), F.struct(-F.col("newest_ratio"), F.col("zona")))).alias("worst"),
        F.min("newest_speed").alias("slowest"),
        F.sum("events").alias("events"),
    )
    slowest = F.col("slowest") if zoned else F.col("velocidad_kmh")
    # Labels and units here and in `zone_kpis_long` are fixed values: dashboards look them up.
    rows = F.array(
        _row("Velocidad promedio (km/h)", text(np_round("velocidad_kmh", 1)), "km/h"),
        _row("Congestión global (ratio)", text(np_round("congestion_ratio", 3)), "ratio 0-1"),
        _row("% Nivel ALTO", text(np_round("pct_alto", 1)), "%"),
        _row("% Nivel MEDIO", text(np_round("pct_medio", 1)), "%"),
        _row("% Nivel BAJO", text(np_round("pct_bajo", 1)), "%"),
        _row("Zona más congestionada", F.col("worst"), "texto"),
        _row("Velocidad mínima zona crítica (km/h)", text(np_round(slowest, 1)), "km/h"),
        _row("Registros con evento activo", text(F.coalesce("events", F.lit(0))), "registros"),
    )
    return total.select(F.inline(rows))


def dominant_level(shares: dict[str, str]) -> Column:
    """Label of the largest share; the first listed wins ties."""
    best = F.greatest(*[F.col(c) for c in shares])
    out = None
    for column, label in shares.items():
        out = F.when(F.col(column) == best, label) if out is None else out.when(F.col(column) == best, label)
    return out


def zone_kpis(gold: DataFrame, latest_speed: bool = False) -> DataFrame:
    return zone_table(zone_sums(gold), latest_speed)


def zone_table(per_zone: DataFrame, latest_speed: bool = False) -> DataFrame:
    names = {"total_vehiculos_zona": "total_vehiculos"}
    table = per_zone.select(
        "zona",
        *([F.col("newest_speed").alias("vel_ultima")] if latest_speed else []),
        *[
            np_round(mean_of(c), 2).alias(names.get(c, c))
            for c in ("velocidad_kmh", "congestion_ratio", "intensidad_veh_hora", "total_vehiculos_zona")
        ],
        *[level_share(v).alias(f"pct_{v}") for v in LEVELS],
        F.col("n_velocidad_kmh").alias("registros"),
    )
    shares = {f"pct_{v}": v for v in LEVELS}
    rounded = table.withColumns({c: np_round(c, 2) for c in shares})
    return rounded.withColumns(
        {
            "lat": lookup("zona", {z.name: z.lat for z in ZONES}),
            "lon": lookup("zona", {z.name: z.lon for z in ZONES}),
            "nivel_dominante": dominant_level(shares),
        }
    )


def zone_kpis_long(gold: DataFrame) -> DataFrame:
    """Eight rows per zone, for cards filtered by a zone slicer."""
    return zone_table_long(zone_sums(gold))


def zone_table_long(per_zone: DataFrame) -> DataFrame:
    wide = zone_table(per_zone, latest_speed=True)
    rows = F.array(
        _row("Velocidad promedio (km/h)", text(np_round("velocidad_kmh", 1)), "km/h"),
        _row("Congestión global (ratio)", text(np_round("congestion_ratio", 3)), "ratio"),
        _row("% Nivel ALTO", text(np_round("pct_alto", 1)), "%"),
        _row("% Nivel MEDIO", text(np_round("pct_medio", 1)), "%"),
        _row("% Nivel BAJO", text(np_round("pct_bajo", 1)), "%"),
        _row("Nivel dominante", F.col("nivel_dominante"), "texto"),
        _row("Velocidad mínima (km/h)", text(np_round("vel_ultima", 1)), "km/h"),
        _row("Total vehiculos promedio", text(np_round("total_vehiculos", 0)), "veh"),
    )
    return wide.select("zona", F.inline(rows))


def hour_kpis(gold: DataFrame) -> DataFrame:
    """Hour-of-day series; without an `hora` column the hour comes from `fecha`."""
    if "hora" not in gold.columns:
        gold = gold.withColumn("hora", F.hour(F.col("fecha").cast("timestamp")))
    return hour_table(gold.groupBy("hora").agg(*sum_columns(gold)))


def hour_table(per_hour: DataFrame) -> DataFrame:
    metrics = [
        np_round(mean_of(c), 3).alias(c)
        for c in ("velocidad_kmh", "congestion_ratio", "intensidad_veh_hora")
        if f"s_{c}" in per_hour.columns
    ]
    if "n_alto" in per_hour.columns:
        metrics.append(np_round(level_share("alto"), 3).alias("pct_alto"))
    series = per_hour.select("hora", *metrics)
    return series.withColumns(
        {"hora_label": hour_label(F.col("hora")), "es_hora_punta": is_peak(F.col("hora")).cast("int")}
    )


def composition_kpis(gold: DataFrame) -> DataFrame:
    """Mean share per vehicle class, in percent, and the same normalised to 100."""
    return composition_table(gold.agg(*sum_columns(gold)))


def composition_table(sums: DataFrame) -> DataFrame:
    """The same from sums, of any number of rows."""
    classes = {f"pct_{k}": label for k, label in VEHICLE_LABELS.items() if f"s_pct_{k}" in sums.columns}
    means = sums.agg(*[np_round(mean_of(c, F.sum), 2).alias(c) for c in classes])
    rows = F.array(
        *[F.struct(F.lit(label).alias("tipo_vehiculo"), F.col(c).alias("porcentaje")) for c, label in classes.items()]
    )
    total = sum([F.coalesce(F.col(c), F.lit(0.0)) for c in list(classes)[1:]], F.coalesce(F.col(list(classes)[0]), F.lit(0.0)))
    long = means.select(F.inline(rows), total.alias("_t"))
    return long.select(
        "tipo_vehiculo",
        "porcentaje",
        np_round(F.try_divide(F.col("porcentaje"), F.col("_t")) * 100, 2).alias("porcentaje_norm"),
    )

