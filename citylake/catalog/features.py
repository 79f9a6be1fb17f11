"""Scalar functions: calendar, congestion metrics, labels, casts."""

from __future__ import annotations

from pyspark.sql import functions as F

from citylake.catalog import oracle as o
from citylake.catalog.registry import query
from citylake.catalog.views import readings, table
from citylake.dims import CAPACITY, FREE_SPEED, MONTH_FACTOR, SERVICE_LABELS, SEVERITY_FACTOR, VEHICLE_SHARES, ZONES
from citylake.functions import timegrain as tg
from citylake.functions import traffic as tf
from citylake.functions.numeric import (
    clip,
    date_or_constant,
    lenient_date,
    lenient_int,
    lenient_timestamp,
    lookup,
    np_round,
    proportional_counts,
)

R = o.ctes(o.READINGS)


@query("time_grain", R + "SELECT event_id, fecha, hora, dia_semana FROM r")
def _(spark, sf):
    return readings(spark, sf).select("event_id", "fecha", "hora", "dia_semana")


@query(
    "time_grain_tz",
    """SELECT event_id, CAST(ts - INTERVAL 5 HOUR AS DATE) AS fecha, CAST(hour(ts - INTERVAL 5 HOUR) AS INTEGER) AS hora,
    CAST(isodow(ts - INTERVAL 5 HOUR) - 1 AS INTEGER) AS dia_semana FROM events""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts")
    return tg.add_time_grain(e, "ts", "America/Lima").drop("ts")


@query(
    "cyclic_hour",
    R + "SELECT event_id, hora, round_even(sin(hora * (2 * pi()) / 24), 4) AS hora_sin, round_even(cos(hora * (2 * pi()) / 24), 4) AS hora_cos FROM r",
)
def _(spark, sf):
    s, c = tg.hour_angle(F.col("hora"))
    return readings(spark, sf).select("event_id", "hora", s.alias("hora_sin"), c.alias("hora_cos"))


@query(
    "hour_flags",
    R + "SELECT event_id, hora IN (7, 8, 9, 17, 18, 19) AS es_hora_punta, dia_semana >= 5 AS es_fin_de_semana FROM r",
)
def _(spark, sf):
    return readings(spark, sf).select(
        "event_id",
        tg.is_peak(F.col("hora")).alias("es_hora_punta"),
        tg.is_weekend(F.col("dia_semana")).alias("es_fin_de_semana"),
    )


@query("day_period", R + f"SELECT event_id, {o.PERIOD} AS periodo_dia FROM r")
def _(spark, sf):
    return readings(spark, sf).select("event_id", tg.day_period(F.col("hora")).alias("periodo_dia"))


@query(
    "day_period_alt",
    R
    + """SELECT event_id, CASE WHEN hora BETWEEN 6 AND 9 THEN 'manana' WHEN hora BETWEEN 10 AND 14 THEN 'mediodia'
    WHEN hora BETWEEN 15 AND 19 THEN 'tarde' WHEN hora >= 20 THEN 'noche' ELSE 'madrugada' END AS periodo_dia FROM r""",
)
def _(spark, sf):
    return readings(spark, sf).select("event_id", tg.day_period_by_meal(F.col("hora")).alias("periodo_dia"))


@query("hour_label", R + "SELECT event_id, printf('%02d:00', hora) AS hora_label FROM r")
def _(spark, sf):
    return readings(spark, sf).select("event_id", tg.hour_label(F.col("hora")).alias("hora_label"))


@query(
    "rain_flags",
    R + "SELECT event_id, precipitacion_mm, coalesce(precipitacion_mm > 0.5, FALSE) AS lluvia_flag, coalesce(precipitacion_mm > 5.0, FALSE) AS lluvia_intensa FROM r",
)
def _(spark, sf):
    mm = F.col("precipitacion_mm")
    return readings(spark, sf).select(
        "event_id",
        mm,
        tf.rain_flag(mm, 0.5).alias("lluvia_flag"),
        tf.rain_flag(mm, 5.0).alias("lluvia_intensa"),
    )


@query(
    "composite_index",
    o.ctes(o.READINGS, "m AS (SELECT max(total_detectado)::DOUBLE AS mx FROM r)")
    + f"SELECT event_id, {o.INDEX.format(f='congestion_factor', r='congestion_ratio', v='total_detectado::DOUBLE', m='(SELECT mx FROM m)')} AS indice_congestion FROM r",
)
def _(spark, sf):
    r = readings(spark, sf)
    busiest = r.agg(F.max("total_detectado").cast("double")).scalar()
    return r.select(
        "event_id",
        tf.composite_index(
            F.col("congestion_factor"), F.col("congestion_ratio"), F.col("total_detectado").cast("double"), busiest
        ).alias("indice_congestion"),
    )


@query(
    "relative_speed",
    R + f"SELECT event_id, least(greatest(round_even(velocidad_kmh / {o.case('zona', FREE_SPEED)}::DOUBLE, 3), 0.0::DOUBLE), 1.5::DOUBLE) AS velocidad_relativa FROM r",
)
def _(spark, sf):
    return readings(spark, sf).select(
        "event_id", tf.relative_speed(F.col("velocidad_kmh"), lookup("zona", FREE_SPEED)).alias("velocidad_relativa")
    )


@query("event_pressure", o.ctes(o.CITY_EVENTS) + "SELECT nombre, round_even(impacto_factor - 1.0::DOUBLE, 3) AS presion_evento FROM ev0")
def _(spark, sf):
    from citylake.catalog.views import city_events

    return city_events(spark, sf).select("nombre", tf.event_pressure(F.col("impacto_factor")).alias("presion_evento"))


@query(
    "flow_ratio",
    R
    + """SELECT event_id, round_even(least(greatest(CAST(k AS DOUBLE) / (CASE WHEN viento_kmh = 0 THEN 1.0::DOUBLE ELSE viento_kmh END), 0.3::DOUBLE), 3.0::DOUBLE), 3) AS ratio_flujo FROM r""",
)
def _(spark, sf):
    return readings(spark, sf).select(
        "event_id", tf.flow_ratio(F.col("k").cast("double"), F.col("viento_kmh")).alias("ratio_flujo")
    )


@query(
    "congestion_label",
    R + f"SELECT event_id, {o.LEVEL.format(f='congestion_factor', i='(v / 100 + 1)')} AS nivel_congestion FROM r",
)
def _(spark, sf):
    return readings(spark, sf).select(
        "event_id", tf.congestion_level(F.col("congestion_factor"), F.col("v") / 100 + 1).alias("nivel_congestion")
    )


@query(
    "coherent_label",
    R
    + """, x AS (SELECT event_id, v / 128 + 1 AS cf, ['alto', 'medio', 'bajo'][k % 3 + 1] AS nivel FROM r)
  SELECT event_id, nivel, CASE WHEN cf < 1.25 THEN 'bajo' WHEN cf < 1.70 THEN CASE nivel WHEN 'bajo' THEN 'bajo' ELSE 'medio' END
    ELSE CASE nivel WHEN 'medio' THEN 'medio' ELSE 'alto' END END AS nivel_coherente FROM x""".replace("WITH", ""),
)
def _(spark, sf):
    drawn = F.element_at(F.array(F.lit("alto"), F.lit("medio"), F.lit("bajo")), F.col("k") % 3 + 1)
    r = readings(spark, sf).select("event_id", drawn.alias("nivel"), (F.col("v") / 128 + 1).alias("cf"))
    return r.select("event_id", "nivel", tf.coherent_level(F.col("nivel"), F.col("cf")).alias("nivel_coherente"))


@query("service_level", R + f"SELECT event_id, {o.SERVICE.format(c='congestion_ratio')} AS nivel_servicio FROM r")
def _(spark, sf):
    return readings(spark, sf).select("event_id", tf.service_level(F.col("congestion_ratio")).alias("nivel_servicio"))


@query(
    "congestion_metrics",
    R
    + """SELECT event_id,
    CASE WHEN k > 0 THEN round_even(v / k, 3) ELSE 0.0::DOUBLE END AS congestion_ratio,
    CASE WHEN k > 0 THEN round_even(coalesce(CASE WHEN k % 5 <> 0 THEN duracion_trafico_s END, k) / k, 3) ELSE 1.0::DOUBLE END AS congestion_factor,
    CASE WHEN coalesce(CASE WHEN k % 5 <> 0 THEN duracion_trafico_s END, k) > 0
      THEN round_even(user_id * 100 / coalesce(CASE WHEN k % 5 <> 0 THEN duracion_trafico_s END, k) * 3.6::DOUBLE, 1) ELSE 0.0::DOUBLE END AS velocidad_kmh
    FROM r""",
)
def _(spark, sf):
    k = F.col("k").cast("double")
    taken = F.when(F.col("k") % 5 != 0, F.col("duracion_trafico_s"))
    metres = (F.col("user_id") * 100).cast("double")
    return readings(spark, sf).select(
        "event_id",
        tf.congestion_ratio(F.col("v"), k).alias("congestion_ratio"),
        tf.trip_factor(k, taken).alias("congestion_factor"),
        tf.trip_speed(metres, k, taken).alias("velocidad_kmh"),
    )


@query(
    "load_pct",
    R
    + f"""SELECT event_id, CAST({o.case('zona', CAPACITY)} * 12 AS INTEGER) AS capacidad_hora,
    round_even(least(greatest(intensidad_veh_hora / greatest({o.case('zona', CAPACITY)} * 12, 1) * 100, 0.0::DOUBLE), 150.0::DOUBLE), 1) AS carga_pct,
    round_even(congestion_ratio * 100, 1) AS ocupacion_pct,
    CAST(floor(5000.0::DOUBLE / greatest({o.case('zona', FREE_SPEED)}::DOUBLE / 3.6::DOUBLE, 1.0::DOUBLE)) AS INTEGER) AS duracion_libre_s FROM r""",
)
def _(spark, sf):
    capacity = tf.hourly_capacity(lookup("zona", CAPACITY))
    return readings(spark, sf).select(
        "event_id",
        capacity.cast("int").alias("capacidad_hora"),
        tf.load_pct(F.col("intensidad_veh_hora"), capacity).alias("carga_pct"),
        tf.occupancy_pct(F.col("congestion_ratio")).alias("ocupacion_pct"),
        tf.indicative_free_seconds(lookup("zona", FREE_SPEED)).alias("duracion_libre_s"),
    )


@query(
    "weather_code",
    """SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 10 / 8.0::DOUBLE > 0.5 THEN 61 WHEN month(o_orderdate) BETWEEN 4 AND 9 THEN 45 ELSE 0 END AS INTEGER) AS codigo_clima FROM orders""",
)
def _(spark, sf):
    rain = F.col("o_orderkey") % 10 / F.lit(8.0)
    return table(spark, sf, "orders").select(
        "o_orderkey", tf.weather_code(rain, F.month("o_orderdate")).alias("codigo_clima")
    )


@query(
    "season_scaling",
    f"""WITH x AS (SELECT o_orderkey, floor(o_totalprice) / 1024.0::DOUBLE AS m, (ARRAY{MONTH_FACTOR})[month(o_orderdate)]::DOUBLE AS fm,
    1.0::DOUBLE / pow(1.035::DOUBLE, CAST(2026 - year(o_orderdate) AS DOUBLE)) AS fa,
    CASE WHEN isodow(o_orderdate) >= 6 THEN 0.75::DOUBLE ELSE 1.125::DOUBLE END AS fd FROM orders)
    SELECT o_orderkey, round_even(least(greatest(m * fd * fm * fa, 0.01::DOUBLE), 200.0::DOUBLE), 4) AS metrica,
    round_even(least(greatest(m / greatest(fd * fm * fa, 0.1::DOUBLE), 3.0::DOUBLE), 130.0::DOUBLE), 4) AS velocidad FROM x""",
)
def _(spark, sf):
    m = F.floor("o_totalprice") / F.lit(1024.0)
    month = tf.month_factor(F.month("o_orderdate"))
    year = tf.year_factor(F.year("o_orderdate"))
    day = F.when(F.weekday("o_orderdate") >= 5, 0.75).otherwise(1.125)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        np_round(tf.seasonal(m, day, month, year, 0.01, 200.0), 4).alias("metrica"),
        np_round(tf.seasonal_speed(m, day, month, year), 4).alias("velocidad"),
    )


@query(
    "allocation",
    f"WITH p AS (SELECT p_partkey, CAST(p_size * 7 AS INTEGER) AS total FROM part) SELECT p_partkey, total, {o.counts_sql('total')} FROM p",
)
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 7).cast("int").alias("total"))
    return p.select("p_partkey", "total", *proportional_counts("total", VEHICLE_SHARES))


@query(
    "device_id",
    """SELECT p_partkey, 'CAM_' || upper(replace(substr(p_name, 1, 6), ' ', '')) || '_' || lpad(CAST(p_size % 2 + 1 AS VARCHAR), 2, '0') AS camara_id,
    p_brand || ',' || p_type AS ids FROM part""",
)
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        tf.camera_id(F.col("p_name"), F.col("p_size") % 2 + 1).alias("camara_id"),
        F.array_join(F.array("p_brand", "p_type"), ",").alias("ids"),
    )


@query(
    "rounding",
    """SELECT l_orderkey, l_linenumber, round_even(l_extendedprice * l_discount, 2) AS r2, round_even(l_extendedprice / 8, 0) AS r0,
    round_even(l_quantity * 1.005::DOUBLE, 1) AS r1 FROM lineitem""",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        np_round(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("r2"),
        np_round(F.col("l_extendedprice") / 8, 0).alias("r0"),
        np_round(F.col("l_quantity") * 1.005, 1).alias("r1"),
    )


@query("clip", "SELECT o_orderkey, least(greatest(o_totalprice, 1000.0::DOUBLE), 200000.0::DOUBLE) AS acotado FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", clip("o_totalprice", 1000.0, 200000.0).alias("acotado"))


@query(
    "lenient_cast",
    R
    + """SELECT event_id, CAST(round_even(TRY_CAST(CASE WHEN k % 5 = 0 THEN 'n/d' ELSE CAST(k AS VARCHAR) || '.5' END AS DOUBLE), 0) AS INTEGER) AS entero FROM r""",
)
def _(spark, sf):
    raw = F.when(F.col("k") % 5 == 0, "n/d").otherwise(F.concat(F.col("k").cast("string"), F.lit(".5")))
    return readings(spark, sf).select("event_id", lenient_int(raw).alias("entero"))


@query(
    "lenient_date",
    """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 4 = 0 THEN 'sin fecha' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS fecha FROM orders""",
)
def _(spark, sf):
    raw = F.when(F.col("o_orderkey") % 4 == 0, "sin fecha").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select("o_orderkey", lenient_date(raw).alias("fecha"))


@query(
    "date_or_constant",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha, DATE '2026-06-28' AS fecha_fija FROM orders",
)
def _(spark, sf):
    """A date column, and the constant that stands in for one the table lacks."""
    o_ = table(spark, sf, "orders")
    return o_.select(
        "o_orderkey",
        date_or_constant(o_, "o_orderdate", "2026-06-28").alias("fecha"),
        date_or_constant(o_, "fecha", "2026-06-28").alias("fecha_fija"),
    )


@query("ts_normalise", "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ingest FROM events")
def _(spark, sf):
    """Batch stamps arrive with and without offset and fraction."""
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    offset = F.concat(plain, F.lit("+00:00"))
    iso = F.when(F.col("event_id") % 2 == 0, offset).otherwise(plain)
    return table(spark, sf, "events").select(
        "event_id", F.date_format(lenient_timestamp(iso), "yyyy-MM-dd HH:mm:ss").alias("ingest")
    )


@query(
    "typed_cast",
    R + "SELECT event_id, CAST(k AS SMALLINT) AS k16, CAST(v AS FLOAT)::DOUBLE AS v32, CAST(k % 2 AS BOOLEAN) AS impar, coalesce(CASE WHEN k % 7 <> 0 THEN k % 2 = 1 END, FALSE) AS bandera FROM r",
)
def _(spark, sf):
    k = F.col("k")
    return readings(spark, sf).select(
        "event_id",
        k.cast("smallint").alias("k16"),
        F.col("v").cast("float").cast("double").alias("v32"),
        (k % 2).cast("boolean").alias("impar"),
        F.coalesce(F.when(k % 7 != 0, k % 2 == 1), F.lit(False)).alias("bandera"),
    )


@query(
    "dim_lookup",
    R
    + f"""SELECT event_id, CAST({o.case('zona', {z.name: z.lat for z in ZONES})} AS DOUBLE) AS lat, CAST({o.case('zona', {z.name: z.lon for z in ZONES})} AS DOUBLE) AS lon,
    {o.case('zona', {z.name: z.corridor for z in ZONES})} AS tipo_corredor,
    {o.case("CAST(k % 6 - 1 AS VARCHAR)", SERVICE_LABELS, "'Desconocido'")} AS nivel_label,
    CAST({o.case("['alta', 'media', 'baja', 'otra'][k % 4 + 1]", SEVERITY_FACTOR, '1.0')} AS DOUBLE) AS impacto FROM r""",
)
def _(spark, sf):
    from citylake.dims import zone_frame

    zones = zone_frame(spark).select("zona", "lat", "lon", "tipo_corredor")
    severity = F.element_at(F.array(*[F.lit(x) for x in ("alta", "media", "baja", "otra")]), F.col("k") % 4 + 1)
    r = readings(spark, sf).select("event_id", "zona", "k")
    return r.join(zones, "zona", "left").select(
        "event_id",
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        "tipo_corredor",
        lookup((F.col("k") % 6 - 1).cast("string"), SERVICE_LABELS, "Desconocido").alias("nivel_label"),
        lookup(severity, SEVERITY_FACTOR, 1.0).alias("impacto"),
    )
