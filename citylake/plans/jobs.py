"""Runnable products: incremental refresh, KPI export, pattern profiles."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.dims import zone_frame
from citylake.operators.advise import route_advice, signal_timing
from citylake.operators import kpi
from citylake.operators.kpi import composition_kpis, global_kpis, hour_kpis, zone_kpis, zone_kpis_long
from citylake.operators.profile import (
    class_probabilities,
    day_moments,
    event_rate,
    merged_moments,
    news_rate,
    probabilities_of,
    profile_of,
    weekday_factors,
    weekday_factors_of,
    zone_hour_profile,
)
from citylake.operators.series import CARRIED, circular_fill, lag_features, lag_features_after, last_rows
from citylake.operators.upsert import replace_days
from citylake.plans.gold import add_features, add_label, flags_as_int, join_sources
from citylake.plans.silver import silver
from citylake.functions.numeric import nan_to_null
from citylake.schemas import conform, landed_schema, to_storage_types
from citylake.session import partition_values, remove_dir, shared_dir
from citylake.sources.readers import read_landed, read_or_empty, touched_dates
from citylake.sources.sinks import overwrite_days, overwrite_table, write_csv


def read_sources(
    spark: SparkSession, bronze_root: str, names: list[str], as_of: datetime, hours: int = 24, extra: str = ""
) -> dict[str, DataFrame]:
    """Rows of each landed source that the days touched by the last hours need.

    A local day can begin up to a day before or after the UTC day, so one day more is
    read at either end. City events are pruned on the day of the event, not of the
    ingest. `extra` declares undeclared columns, as DDL.
    """
    first, last = touched_dates(as_of, hours)
    near = (first - timedelta(days=1), last + timedelta(days=1))
    out = {}
    for name in names:
        landed = read_landed(spark, f"{bronze_root}/{name}", landed_schema(name, extra))
        day = "event_date" if name == "eventos" else "ingest_date"
        out[name] = nan_to_null(landed.filter(F.col(day).between(*near)))
    return out


def kpi_tables(gold: DataFrame) -> dict[str, DataFrame]:
    return {
        "kpi_resumen": global_kpis(gold),
        "kpi_por_zona": zone_kpis(gold),
        "kpi_resumen_por_zona": zone_kpis_long(gold),
        "kpi_serie_temporal": hour_kpis(gold),
        "kpi_composicion": composition_kpis(gold),
    }


def kpi_tables_of(partials: DataFrame) -> dict[str, DataFrame]:
    """The same tables from the sums of days."""
    zones = kpi.merged(partials, "zona")
    return {
        "kpi_resumen": kpi.global_table(zones),
        "kpi_por_zona": kpi.zone_table(zones),
        "kpi_resumen_por_zona": kpi.zone_table_long(zones),
        "kpi_serie_temporal": kpi.hour_table(kpi.merged(partials, "hora")),
        "kpi_composicion": kpi.composition_table(zones),
    }


def stale_days(spark: SparkSession, gold_path: str, partial_path: str, touched: list[date]) -> list[date]:
    """Days whose sums are not those of the gold table: the touched ones and those never summed.

    Both lists are folder names; no file is opened."""
    there, summed = (set(partition_values(spark, p, "fecha")) for p in (gold_path, partial_path))
    return sorted(date.fromisoformat(d) for d in there & (there - summed | {str(d) for d in touched}))


def refresh_kpi_partials(spark: SparkSession, gold_path: str, partial_path: str, touched: list[date]) -> None:
    """Sum the stale days of gold and put them into the table of sums, whole days at a time.

    The day filter prunes gold by partition. A day is replaced, never added to, so a run that
    is repeated or cut short leaves no day counted twice."""
    days = stale_days(spark, gold_path, partial_path, touched)
    if days:
        gold = spark.read.parquet(gold_path).filter(F.col("fecha").isin(days))
        overwrite_days(kpi.day_partials(gold), partial_path, "fecha")


def export_kpis(
    gold: DataFrame, path: str, model_results: DataFrame | None = None, tables: dict[str, DataFrame] | None = None
) -> None:
    tables = dict(tables or kpi_tables(gold))
    if model_results is not None:
        tables["kpi_ml_resultados"] = model_results
    for name, table in tables.items():
        write_csv(table, f"{path}/{name}")


def build_gold(
    sources: dict[str, DataFrame], gold_root: str, busiest: float | None = None, storage: bool = True, tz: str = "UTC"
) -> DataFrame:
    """Full rebuild of the three gold tables from cleaned sources.

    The joined base is written once and removed at the end. The camera maximum, the
    features and both advice tables then start from it, so no source is scanned twice.
    Days and hours are those of `tz`.
    """
    spark = next(iter(sources.values())).sparkSession
    stage = shared_dir(spark, "gold-base")
    join_sources(sources, tz).write.parquet(stage)
    base = spark.read.parquet(stage)
    labelled = flags_as_int(add_label(lag_features(add_features(base, busiest))))
    target = f"{gold_root}/congestion_por_zona"
    overwrite_days(to_storage_types(labelled) if storage else labelled, target, "fecha", ["zona", "hora"])
    remove_dir(spark, stage)
    gold = spark.read.parquet(target)
    write_advice(gold, gold_root)
    return gold


def write_advice(gold: DataFrame, gold_root: str) -> None:
    overwrite_days(route_advice(gold), f"{gold_root}/recomendaciones_ruta", "fecha", ["zona", "hora"])
    overwrite_days(signal_timing(gold), f"{gold_root}/semaforos_simulados", "fecha", ["zona", "hora"])


def refresh_gold(
    spark: SparkSession,
    bronze_root: str,
    gold_root: str,
    sources: list[str],
    as_of: datetime,
    busiest: float,
    hours: int = 24,
    relabel: Callable[[DataFrame], DataFrame] | None = None,
    dry_run: bool = False,
    order: dict[str, list[str]] | None = None,
    storage: bool = True,
    tz: str = "UTC",
    extra: str = "",
    kpis: str | None = None,
) -> DataFrame:
    """Recompute the days touched by the last hours and put them into gold.

    Silver, gold, an optional relabelling, the replacement of whole days, advice and,
    where a `kpis` folder is named, the KPI export run as one job. The export adds up
    sums that are kept per day, so it reads gold for the touched days only. Days and hours
    are those of `tz`.

    `busiest` is the fixed camera reference, so that a refresh and a full rebuild
    give the same index. `relabel` may replace the rule label by a model's.
    A dry run returns the fresh rows and writes nothing. `storage` narrows floats
    to 32 bits on writing.
    """
    cleaned = silver(read_sources(spark, bronze_root, sources, as_of, hours, extra), order)
    first, last = touched_dates(as_of, hours)
    complete = join_sources(cleaned, tz).filter(F.col("fecha").between(first, last))
    # Written once: the lags, the labels and the search for earlier rows start from files.
    stage = shared_dir(spark, "gold-fresh")
    flags_as_int(add_features(complete, busiest)).write.parquet(stage)
    featured = spark.read.parquet(stage)
    target, state = f"{gold_root}/congestion_por_zona", f"{gold_root}/ultimas_filas"
    before = rows_before(spark, target, state, featured, first)
    fresh = add_label(lag_features_after(featured, before))
    if relabel is not None:
        fresh = relabel(fresh)
    if dry_run:
        return fresh
    for day in partition_values(spark, state, "fecha"):
        if date.fromisoformat(day) >= first:
            remove_dir(spark, f"{state}/fecha={day}")
    replace_days(to_storage_types(fresh) if storage else fresh, target)
    gold = spark.read.parquet(target)
    keep_last_rows(gold, state, before, [d for v in partition_values(spark, target, "fecha") if (d := date.fromisoformat(v)) >= first])
    remove_dir(spark, stage)
    write_advice(gold.filter(F.col("fecha").between(first, last)), gold_root)
    if kpis is not None:
        partials, touched = f"{gold_root}/kpi_parciales", [first + timedelta(days=k) for k in range((last - first).days + 1)]
        refresh_kpi_partials(spark, target, partials, touched)
        export_kpis(gold, kpis, tables=kpi_tables_of(spark.read.parquet(partials)))
    return gold


LAST_ROWS = "zona string, dia date, hora int, congestion_factor double, indice_congestion double, fecha date"


def rows_before(spark: SparkSession, target: str, state: str, fresh: DataFrame, first: date) -> DataFrame:
    """The last stored row of each zone before the day `first`.

    They are one partition of the state table, that of the newest gold day before `first`.
    Where it is missing (the table is new, or a run was cut short between the two writes,
    which removes it first) gold is searched backwards."""
    days = [d for v in partition_values(spark, target, "fecha") if (d := date.fromisoformat(v)) < first]
    if days and str(max(days)) in partition_values(spark, state, "fecha"):
        kept = spark.read.schema(LAST_ROWS).parquet(state).filter(F.col("fecha") == F.lit(max(days)))
        return kept.drop("fecha").withColumnRenamed("dia", "fecha").select(*CARRIED)
    stored = conform(read_or_empty(spark, target, fresh.schema), fresh.schema)
    return last_rows(stored.select(*CARRIED), fresh, days)


def keep_last_rows(gold: DataFrame, state: str, before: DataFrame, days: list[date]) -> None:
    """For each of the newest gold `days`, the last row of each zone up to it.

    Only these days are read, reduced to one row per zone and day; a row is then handed on to
    the days after it until a later one takes its place."""
    if not days:
        return
    daily = gold.filter(F.col("fecha").isin(days)).groupBy("zona", F.col("fecha").alias("dia")).agg(
        F.max("hora").alias("hora"), *[F.max_by(c, "hora").cast("double").alias(c) for c in CARRIED[3:]]
    )
    rows = daily.unionByName(before.select("zona", F.col("fecha").alias("dia"), *CARRIED[2:]))
    later = F.filter(F.array(*[F.lit(d) for d in days]), lambda d: d >= F.col("dia"))
    newest = F.max_by(F.struct("dia", "hora", *CARRIED[3:]), F.struct("dia", "hora"))
    kept = rows.withColumn("fecha", F.explode(later)).groupBy("fecha", "zona").agg(newest.alias("x"))
    overwrite_days(kept.select("zona", "x.*", "fecha"), state, "fecha")


# ---- fixed values: profile metrics and fallbacks ------------------------------
PROFILE_METRICS = [
    "congestion_ratio", "velocidad_kmh", "congestion_factor", "intensidad_veh_hora",
    "temperatura_c", "humedad_pct", "precipitacion_mm", "viento_kmh",
]
PROFILE_DEFAULTS = {
    "mean_congestion_ratio": 0.50, "std_congestion_ratio": 0.08,
    "mean_velocidad_kmh": 35.0, "std_velocidad_kmh": 5.0,
    "mean_congestion_factor": 2.0, "std_congestion_factor": 0.3,
}
# ---- end of fixed values ------------------------------------------------------


def learn_profiles(gold: DataFrame, events: DataFrame, news: DataFrame, as_of, zones: int, days: int = 7) -> dict[str, DataFrame]:
    """All learned pattern tables of the last `days` days before `as_of`.

    The window is what the caller asks for, however many rows it holds;
    `recent_or_wider` is there for callers that want a wider one on thin data.
    """
    recent = gold.filter(F.col("fecha") >= F.date_sub(as_of, days))
    places = zone_frame(gold.sparkSession).select("zona")
    metrics = [m for m in PROFILE_METRICS if m in gold.columns]
    columns = [f"{p}_{m}" for p in ("mean", "std") for m in metrics]
    return {
        "perfil_hora": circular_fill(zone_hour_profile(recent, metrics), columns, PROFILE_DEFAULTS, keys=places),
        "factor_dia": weekday_factors(recent),
        "prob_nivel": class_probabilities(recent, keys=places),
        "eventos": event_rate(events, zones),
        "noticias": news_rate(news),
    }


def refresh_moments(gold: DataFrame, path: str) -> None:
    """Put the moments of the days of `gold` into the table of moments, whole days at a time."""
    metrics = [m for m in PROFILE_METRICS if m in gold.columns]
    overwrite_days(day_moments(gold, metrics), path, "fecha")


def sliding_profiles(moments: DataFrame, as_of: date, days: int = 7) -> dict[str, DataFrame]:
    """The tables learned from gold for the window that ends on `as_of`, from moments alone:
    the next window costs no scan of gold."""
    first = as_of - timedelta(days=days)
    metrics = [m for m in PROFILE_METRICS if f"s_{m}" in moments.columns]
    columns = [f"{p}_{m}" for p in ("mean", "std") for m in metrics]
    places = zone_frame(moments.sparkSession).select("zona")
    merged = merged_moments(moments, first, as_of, metrics)
    hours = places.select("zona", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hora"))
    counts = merged.select("zona", "hora", "n", "labelled", *[c for c in merged.columns if c.startswith("n_")])
    counts = hours.join(counts, ["zona", "hora"], "left").fillna(0)
    return {
        "perfil_hora": circular_fill(profile_of(merged, metrics), columns, PROFILE_DEFAULTS, keys=places),
        "factor_dia": weekday_factors_of(moments, first, as_of),
        "prob_nivel": probabilities_of(counts),
    }


def write_profiles(profiles: dict[str, DataFrame], path: str) -> None:
    for name, table in profiles.items():
        overwrite_table(table, f"{path}/{name}")


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: several outputs then start
    from files instead of recomputing the joins, and survive lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
