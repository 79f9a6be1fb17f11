"""City events: forward window, sub-source union, severity factor, sentinel row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.dims import SEVERITY_FACTOR
from citylake.functions.numeric import lookup


def in_window(day: Column, as_of: Column, days: int = 7) -> Column:
    """Inclusive on both ends."""
    return day.between(as_of, F.date_add(as_of, days))


def official_holidays(days: DataFrame, as_of: Column, origin: str = "feriados") -> DataFrame:
    """Nationwide holidays (`fecha`, `nombre`) as events of medium severity for every zone."""
    return days.filter(in_window(F.col("fecha"), as_of)).select(
        "fecha",
        F.lit("00:00").alias("hora_inicio"),
        F.lit("23:59").alias("hora_fin"),
        "nombre",
        F.lit("feriado_oficial").alias("tipo"),
        F.lit("Nacional").alias("venue"),
        F.lit("todas").alias("zona_afectada"),
        F.lit("media").alias("severidad"),
        F.lit(SEVERITY_FACTOR["media"]).alias("impacto_factor"),
        F.datediff("fecha", as_of).alias("dias_para_evento"),
        F.lit(origin).alias("sub_fuente"),
    )


def calendar_events(calendar: DataFrame, as_of: Column, origin: str = "calendario") -> DataFrame:
    return calendar.filter(in_window(F.col("fecha"), as_of)).withColumns(
        {
            "impacto_factor": lookup("severidad", SEVERITY_FACTOR, 1.0),
            "dias_para_evento": F.datediff("fecha", as_of),
            "sub_fuente": F.lit(origin),
        }
    )


def with_sentinel(events: DataFrame, sentinel: DataFrame) -> DataFrame:
    """The events, or the one sentinel row where there are none.

    The emptiness test is a scalar subquery over one row at most, so the events
    are not counted in full.
    """
    found = events.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    return events.unionByName(sentinel.filter(found == 0), allowMissingColumns=True)


def agenda(holidays: DataFrame, calendar: DataFrame, as_of: Column) -> DataFrame:
    events = official_holidays(holidays, as_of).unionByName(
        calendar_events(calendar, as_of), allowMissingColumns=True
    )
    quiet = holidays.sparkSession.range(1).select(
        as_of.alias("fecha"),
        F.lit("Sin eventos relevantes").alias("nombre"),
        F.lit("ninguno").alias("tipo"),
        F.lit("ninguna").alias("zona_afectada"),
        F.lit("ninguna").alias("severidad"),
        F.lit(1.0).alias("impacto_factor"),
        F.lit(0).alias("dias_para_evento"),
        F.lit("sistema").alias("sub_fuente"),
    )
    return with_sentinel(events, quiet)
