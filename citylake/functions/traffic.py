"""Congestion metrics, labels and advice rules as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citylake.dims import (
    GREEN_BASE,
    GREEN_MAX,
    GREEN_MIN,
    MONTH_FACTOR,
    REFERENCE_YEAR,
    SERVICE_CUTS,
    YEARLY_GROWTH,
)
from citylake.functions.numeric import clip, null_to_false, np_round


def rain_flag(mm: Column, above: float) -> Column:
    return null_to_false(mm > above)


def composite_index(factor: Column, ratio: Column, vehicles: Column, busiest: Column) -> Column:
    """GPS 60 %, sensors 30 %, cameras 10 %; each part is 1.0 when unknown."""
    # `busiest` is named once: it may be a subquery over all cameras.
    share = F.try_divide(F.coalesce(vehicles, F.lit(0.0)), F.greatest(busiest, F.lit(0.0)))
    camera = F.coalesce(share + 1.0, F.lit(1.0))
    return np_round(
        F.coalesce(factor, F.lit(1.0)) * 0.60
        + (F.coalesce(ratio, F.lit(0.0)) + 1.0) * 0.30
        + camera * 0.10,
        3,
    )


def relative_speed(speed: Column, free_speed: Column) -> Column:
    return clip(np_round(F.try_divide(speed, free_speed), 3), 0.0, 1.5)


def event_pressure(impact: Column) -> Column:
    return np_round(impact - 1.0, 3)


def flow_ratio(inflow: Column, outflow: Column) -> Column:
    divisor = F.when(outflow == 0, F.lit(1.0)).otherwise(outflow)
    return np_round(clip(inflow / divisor, 0.3, 3.0), 3)


def congestion_level(factor: Column, index: Column) -> Column:
    """Label from the GPS factor, or from the composite index where there is none."""
    by_factor = F.when(factor < 1.25, "bajo").when(factor < 1.70, "medio").otherwise("alto")
    by_index = F.when(index < 1.25, "bajo").when(index < 1.60, "medio").otherwise("alto")
    return F.when(factor.isNotNull(), by_factor).otherwise(by_index)


def coherent_level(level: Column, factor: Column) -> Column:
    """Pull a drawn label towards what the factor allows."""
    return (
        F.when(factor < 1.25, "bajo")
        .when(factor < 1.70, F.when(level == "bajo", "bajo").otherwise("medio"))
        .otherwise(F.when(level == "medio", "medio").otherwise("alto"))
    )


def service_level(ratio: Column) -> Column:
    graded = F.when(ratio.isNull(), F.lit(None).cast("string"))
    for cut, grade in SERVICE_CUTS:
        graded = graded.when(ratio < cut, grade)
    return graded.otherwise("F")


def congestion_ratio(intensity: Column, saturation: Column) -> Column:
    return F.when(saturation > 0, np_round(F.try_divide(intensity, saturation), 3)).otherwise(F.lit(0.0))


def trip_factor(free_s: Column, traffic_s: Column) -> Column:
    taken = F.coalesce(traffic_s, free_s)
    return F.when(free_s > 0, np_round(F.try_divide(taken, free_s), 3)).otherwise(F.lit(1.0))


def trip_speed(distance_m: Column, free_s: Column, traffic_s: Column) -> Column:
    taken = F.coalesce(traffic_s, free_s)
    return F.when(taken > 0, np_round(F.try_divide(distance_m, taken) * 3.6, 1)).otherwise(F.lit(0.0))


def hourly_capacity(capacity: Column) -> Column:
    """Five-minute capacity to vehicles per hour."""
    return capacity * 12


def load_pct(intensity: Column, capacity: Column) -> Column:
    return np_round(clip(intensity / F.greatest(capacity, F.lit(1)) * 100, 0.0, 150.0), 1)


def occupancy_pct(ratio: Column) -> Column:
    return np_round(ratio * 100, 1)


def indicative_free_seconds(free_speed: Column, metres: float = 5000.0) -> Column:
    return F.floor(metres / F.greatest(free_speed / 3.6, F.lit(1.0))).cast("int")


def weather_code(rain_mm: Column, month: Column) -> Column:
    return F.when(rain_mm > 0.5, 61).when(month.between(4, 9), 45).otherwise(0)


def month_factor(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in MONTH_FACTOR]), month)


def year_factor(year: Column, reference: int = REFERENCE_YEAR) -> Column:
    """Past years scaled down by the yearly growth."""
    return 1.0 / F.pow(F.lit(1.0 + YEARLY_GROWTH), (F.lit(reference) - year).cast("double"))


def seasonal(metric: Column, weekday: Column, month: Column, year: Column, low: float, high: float | None) -> Column:
    """Metric that grows with demand."""
    return clip(metric * weekday * month * year, low, high)


def seasonal_speed(speed: Column, weekday: Column, month: Column, year: Column) -> Column:
    """Speed falls as demand grows."""
    return clip(speed / F.greatest(weekday * month * year, F.lit(0.1)), 3.0, 130.0)


def green_seconds(ratio: Column) -> Column:
    return np_round(clip(ratio * float(GREEN_BASE), float(GREEN_MIN), float(GREEN_MAX))).cast("int")


def signal_action(ratio: Column) -> Column:
    return F.when(ratio > 1.20, "ampliar_verde").when(ratio < 0.80, "reducir_verde").otherwise("mantener")


def minutes_saved(own_s: Column, other_s: Column) -> Column:
    return np_round(F.coalesce(F.greatest(F.lit(0.0), (own_s - other_s) / 60), F.lit(0.0)), 1)


def advice_status(own_factor: Column, other_factor: Column, other_level: Column) -> Column:
    better = null_to_false(other_factor < own_factor) & (other_level != "alto")
    return F.when(better, "RECOMENDADA").otherwise("ALTERNATIVA_POSIBLE")


def camera_id(zone: Column, number: Column) -> Column:
    stem = F.upper(F.replace(F.substring(zone, 1, 6), F.lit(" "), F.lit("")))
    return F.concat(F.lit("CAM_"), stem, F.lit("_"), F.lpad(number.cast("string"), 2, "0"))
