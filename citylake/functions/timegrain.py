"""Calendar grain and hour-of-day expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.dims import PEAK_HOURS
from citylake.functions.numeric import np_round


def add_time_grain(df: DataFrame, ts: str = "_ingest_ts", tz: str = "UTC") -> DataFrame:
    """Add `fecha`, `hora`, `dia_semana` (0 = Monday); `tz` names the wall clock to read."""
    clock = F.col(ts)
    if tz != "UTC":
        clock = F.convert_timezone(F.lit("UTC"), F.lit(tz), clock.cast("timestamp_ntz"))
    return df.withColumns(
        {
            "fecha": F.to_date(clock),
            "hora": F.hour(clock),
            "dia_semana": F.weekday(clock),
        }
    )


def batch_start(ts: str, minutes: int = 5) -> Column:
    """Start of the ingest batch that a reading belongs to."""
    step = minutes * 60
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(step)))


def hour_angle(hour: Column) -> tuple[Column, Column]:
    angle = hour * (2 * math.pi) / 24
    return np_round(F.sin(angle), 4), np_round(F.cos(angle), 4)


def is_peak(hour: Column) -> Column:
    return hour.isin(PEAK_HOURS)


def is_weekend(weekday: Column) -> Column:
    return weekday >= 5


def day_period(hour: Column) -> Column:
    return (
        F.when(hour <= 5, "madrugada")
        .when(hour <= 11, "manana")
        .when(hour <= 16, "tarde")
        .when(hour <= 20, "noche_temprana")
        .when(hour <= 23, "noche")
    )


def day_period_by_meal(hour: Column) -> Column:
    """The second naming scheme, used for synthetic history."""
    return (
        F.when(hour.between(6, 9), "manana")
        .when(hour.between(10, 14), "mediodia")
        .when(hour.between(15, 19), "tarde")
        .when(hour.between(20, 23), "noche")
        .otherwise("madrugada")
    )


def hour_label(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))
