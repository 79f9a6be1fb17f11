"""Hourly series: lags, latest rows, circular gap filling, calendar grids."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citylake.functions.numeric import np_round


#: What a row hands on to the next hour of its zone.
CARRIED = ["zona", "fecha", "hora", "congestion_factor", "indice_congestion"]


def lag_features(gold: DataFrame, key: str = "zona", order: list[str] = ("fecha", "hora")) -> DataFrame:
    """Previous row per zone (gaps are not filled) and the index trend.

    Runs on the hourly table, where a zone has one row per hour of history
    however many readings it had: the window group is bounded by the calendar.
    """
    w = Window.partitionBy(key).orderBy(*order)
    lagged = gold.withColumns(
        {
            "congestion_factor_lag1h": F.lag("congestion_factor").over(w),
            "indice_congestion_lag1h": F.lag("indice_congestion").over(w),
        }
    )
    trend = np_round(F.col("indice_congestion") - F.col("indice_congestion_lag1h"), 3)
    return lagged.withColumn("tendencia_congestion", F.coalesce(trend, F.lit(0.0))).withColumns(
        {
            "congestion_factor_lag1h": F.coalesce("congestion_factor_lag1h", "congestion_factor"),
            "indice_congestion_lag1h": F.coalesce("indice_congestion_lag1h", "indice_congestion"),
        }
    )


def last_rows(history: DataFrame, zones: DataFrame, days: list[date]) -> DataFrame:
    """The newest stored row of each zone, reading as few of the stored `days` as hold one.

    Starts with the newest day and doubles the span back while a zone of `zones` has no
    row in it; every step is bounded on both sides by partition.
    """
    days, span = sorted(days), 1
    wanted = zones.select("zona").distinct()
    while True:
        part = days[-span:]
        near = history.filter(F.col("fecha").between(part[0], part[-1])) if part else history.filter(F.lit(False))
        last = latest_rows(near)
        if span >= len(days) or wanted.join(last, "zona", "left_anti").isEmpty():
            return last
        span *= 2


def lag_features_incremental(fresh: DataFrame, history: DataFrame, days: list[date]) -> DataFrame:
    """Lags for a run that sees recent hours only.

    The last stored hour of each zone among the stored `days` (all before the fresh
    ones) is put in front of the fresh rows, so the first fresh row has the same lag a
    full run would give it.
    """
    return lag_features_after(fresh, last_rows(history.select(*CARRIED), fresh, days))


def lag_features_after(fresh: DataFrame, last: DataFrame) -> DataFrame:
    """Lags of fresh rows that follow the one row per zone in `last`."""
    both = fresh.withColumn("_carry", F.lit(False)).unionByName(
        last.select(*CARRIED, F.lit(True).alias("_carry")), allowMissingColumns=True
    )
    return lag_features(both).filter(~F.col("_carry")).drop("_carry")


def latest_rows(df: DataFrame, key: str = "zona", order: list[str] = ("fecha", "hora")) -> DataFrame:
    """Newest row per zone; each task passes on one row per key only."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def circular_fill(
    profile: DataFrame, metrics: list[str], defaults: dict[str, float], key: str = "zona", keys: DataFrame | None = None
) -> DataFrame:
    """A full 24-hour profile per zone, and for every row of `keys` if given.

    A missing hour takes the mean of the observed hours one and two steps away
    around midnight, or the defaults if there are none. Every observed hour is
    sent to the five hours it can serve and one aggregation picks up the rest, so
    there is no self-join. Filled hours never feed other filled hours.
    """
    sent = profile.select(key, "hora", *metrics, F.explode(F.array(*[F.lit(d) for d in (-2, -1, 0, 1, 2)])).alias("_d"))
    sent = sent.withColumn("hora", F.pmod(F.col("hora") + F.col("_d"), F.lit(24)).cast("int"))
    hours = F.explode(F.sequence(F.lit(0), F.lit(23)))
    known = profile.select(key) if keys is None else profile.select(key).union(keys.select(key))
    frame = known.distinct().select(key, hours.alias("hora"))
    own = F.col("_d") == 0
    merged = sent.unionByName(frame, allowMissingColumns=True).groupBy(key, "hora").agg(
        F.coalesce(F.bool_or(own), F.lit(False)).alias("observado"),
        *[F.max(F.when(own, F.col(m))).alias(f"_own_{m}") for m in metrics],
        *[F.avg(F.when(~own, F.col(m))).alias(f"_near_{m}") for m in metrics],
    )
    return merged.select(
        key,
        "hora",
        "observado",
        *[
            F.when(F.col("observado"), F.col(f"_own_{m}"))
            .otherwise(F.coalesce(F.col(f"_near_{m}"), F.lit(defaults.get(m))))
            .alias(m)
            for m in metrics
        ],
    )


def hour_grid(zones: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every hour of the days first..last for every zone row."""
    start = F.to_timestamp(first)
    stop = F.to_timestamp(F.date_add(last, 1)) - F.expr("INTERVAL 1 HOUR")
    hours = F.sequence(start, stop, F.expr("INTERVAL 1 HOUR"))
    stamped = zones.withColumn("_ts", F.explode(hours))
    return stamped.withColumns({"fecha": F.to_date("_ts"), "hora": F.hour("_ts")}).drop("_ts")


def fill_gaps(facts: DataFrame, grid: DataFrame, key: list[str] = ("zona", "fecha", "hora")) -> DataFrame:
    return grid.join(facts, list(key), "left")


def ratio_to_total(df: DataFrame, value: str, out: str, scale: float = 1.0) -> DataFrame:
    """Share of the grand total, which is one number fetched by a scalar subquery."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, F.try_divide(F.col(value), total) * scale)
