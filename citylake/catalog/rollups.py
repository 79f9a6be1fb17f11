"""Aggregations, joins, ordered operators and learned profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from citylake.catalog import oracle as o
from citylake.catalog.products import cleaned, gold
from citylake.catalog.registry import query
from citylake.catalog.views import bronze_sources, city_events, news, pick, readings, table
from citylake.dims import DETECTORS, EVENT_TYPES, SENTIMENTS, ZONE_NAMES, detector_frame, zone_frame
from citylake.functions.numeric import clip, np_round
from citylake.functions.timegrain import add_time_grain
from citylake.operators import profile as pf
from citylake.operators import rollup as ru
from citylake.operators import series as se
from citylake.operators.advise import with_alternatives
from citylake.operators.kpi import dominant_level
from citylake.plans.gold import join_sources
from citylake.plans.jobs import PROFILE_DEFAULTS

R = o.ctes(o.READINGS)
CAMS = o.ctes(o.READINGS, o.CAMERAS_RAW, o.SILVER_CAMERAS, o.CAMERAS_HOURLY, o.FLOW)


@query("hourly_mean_mode", o.ctes(o.SILVER, o.HOURLY) + "SELECT * FROM g_sen LEFT JOIN m_niv USING (zona, fecha, hora)")
def _(spark, sf):
    return ru.sensors_hourly(add_time_grain(cleaned(spark, sf, "sensores_trafico")["sensores_trafico"]))


@query("hourly_weather", o.ctes(o.SILVER, o.HOURLY) + "SELECT * FROM g_cli LEFT JOIN m_cod USING (zona, fecha, hora)")
def _(spark, sf):
    out = ru.weather_hourly(add_time_grain(cleaned(spark, sf, "clima")["clima"]))
    return out.withColumn("codigo_clima", F.col("codigo_clima").cast("int"))


@query("hourly_mean", o.ctes(o.SILVER, o.HOURLY) + "SELECT * FROM g_gps")
def _(spark, sf):
    return ru.gps_hourly(add_time_grain(cleaned(spark, sf, "gps_rutas")["gps_rutas"]))


def _cameras(spark, sf):
    return ru.cameras_hourly(add_time_grain(cleaned(spark, sf, "vision_camaras")["vision_camaras"]))


@query("two_level_sum_mean", CAMS + "SELECT zona, fecha, hora, total_vehiculos_zona FROM g_cam")
def _(spark, sf):
    return _cameras(spark, sf).select("zona", "fecha", "hora", "total_vehiculos_zona")


@query("composition_pct", CAMS + "SELECT * EXCLUDE (total_vehiculos_zona) FROM g_cam")
def _(spark, sf):
    return _cameras(spark, sf).drop("total_vehiculos_zona", "vehiculos_entrada", "vehiculos_salida")


@query("directional_flow", CAMS + "SELECT * FROM g_flow")
def _(spark, sf):
    return _cameras(spark, sf).select("zona", "fecha", "hora", "vehiculos_entrada", "vehiculos_salida")


@query("conditional_counts", o.ctes(o.SILVER, o.NEWS_HOURLY) + "SELECT * FROM g_nw")
def _(spark, sf):
    return ru.news_hourly(add_time_grain(cleaned(spark, sf, "redes_noticias")["redes_noticias"]))


_IDS = [s for sensors in DETECTORS.values() for s in sensors] + ["0001", "0002"]
_PAIRS = ", ".join(f"('{s}', {o.q(z)})" for z, sensors in DETECTORS.items() for s in sensors)


def detector_readings(spark, sf):
    """Lineitem rows as detector readings, two of the seventeen ids belonging to no zone."""
    line = table(spark, sf, "lineitem")
    return line.select(
        pick(F.col("l_partkey") % 17, _IDS).alias("sensor_id"),
        F.to_date("l_shipdate").alias("fecha"),
        F.col("l_quantity").cast("int").alias("intensidad"),
        (F.col("l_suppkey") % 100).cast("int").alias("ocupacion"),
        (F.col("l_partkey") % 100).cast("int").alias("carga"),
        (F.col("l_quantity") + F.col("l_linenumber") - 2).cast("int").alias("saturacion"),
        F.when(F.col("l_linenumber") == 7, "-1").otherwise((F.col("l_linenumber") % 4).cast("string")).alias("nivel"),
        F.when(F.col("l_returnflag") == "A", "S").otherwise("N").alias("error"),
    )


DETECTOR_SQL = f"""d AS (SELECT {o.sql_list(_IDS)}[CAST(l_partkey % 17 AS INTEGER) + 1] AS sensor_id, CAST(l_shipdate AS DATE) AS fecha,
    CAST(l_quantity AS INTEGER) AS intensidad, CAST(l_suppkey % 100 AS INTEGER) AS ocupacion, CAST(l_partkey % 100 AS INTEGER) AS carga,
    CAST(l_quantity + l_linenumber - 2 AS INTEGER) AS saturacion,
    CASE WHEN l_linenumber = 7 THEN '-1' ELSE CAST(l_linenumber % 4 AS VARCHAR) END AS nivel,
    CASE WHEN l_returnflag = 'A' THEN 'S' ELSE 'N' END AS error FROM lineitem),
m AS (SELECT * FROM (VALUES {_PAIRS}) t(sensor_id, zona))"""


@query(
    "cluster_agg",
    o.ctes(
        DETECTOR_SQL,
        """g AS (SELECT zona, fecha, avg(intensidad) AS i, avg(ocupacion) AS oc, avg(carga) AS ca, avg(saturacion) AS sa,
    max(CAST(nivel AS INTEGER)) AS nv, count(*) AS n FROM d JOIN m USING (sensor_id) WHERE error = 'N' AND nivel <> '-1' GROUP BY zona, fecha)""",
        """x AS (SELECT zona, fecha, CAST(round_even(i, 0) AS INTEGER) AS intensidad_veh_hora, round_even(oc, 1) AS ocupacion_pct,
    round_even(ca, 1) AS carga_pct, CAST(round_even(sa, 0) AS INTEGER) AS capacidad_veh_hora,
    CASE WHEN sa > 0 THEN round_even(i / sa, 3) ELSE 0.0::DOUBLE END AS congestion_ratio, CAST(nv AS VARCHAR) AS nivel_servicio,
    ['Fluido', 'Lento', 'Retenido', 'Cortado'][nv + 1] AS nivel_label, CAST(n AS INTEGER) AS sensores_activos FROM g)""",
    )
    + "SELECT * FROM x WHERE congestion_ratio BETWEEN 0 AND 1 AND intensidad_veh_hora >= 0",
)
def _(spark, sf):
    return ru.detector_clusters(detector_readings(spark, sf), detector_frame(spark), "fecha")


@query(
    "id_cluster_join",
    o.ctes(DETECTOR_SQL) + "SELECT zona, sensor_id, count(*) AS n, max(intensidad) AS intensidad_max FROM d JOIN m USING (sensor_id) GROUP BY ALL",
)
def _(spark, sf):
    joined = detector_readings(spark, sf).join(detector_frame(spark), "sensor_id")
    return joined.groupBy("zona", "sensor_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("intensidad").alias("intensidad_max")
    )


@query(
    "value_counts",
    "SELECT o_orderpriority, count(*) AS n, count(*) / (SELECT count(*) FROM orders) AS proporcion FROM orders GROUP BY 1",
)
def _(spark, sf):
    return pf.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query(
    "dominant_class",
    R
    + """, x AS (SELECT zona, hora, round_even(count(*) FILTER (WHERE congestion_factor >= 1.70)::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE, 2) AS pct_alto,
    round_even(count(*) FILTER (WHERE congestion_factor >= 1.25 AND congestion_factor < 1.70)::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE, 2) AS pct_medio,
    round_even(count(*) FILTER (WHERE congestion_factor < 1.25)::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE, 2) AS pct_bajo FROM r GROUP BY zona, hora)
    SELECT *, CASE WHEN pct_alto >= pct_medio AND pct_alto >= pct_bajo THEN 'alto' WHEN pct_medio >= pct_bajo THEN 'medio' ELSE 'bajo' END AS nivel_dominante FROM x""",
)
def _(spark, sf):
    from citylake.functions.numeric import share_of

    f = F.col("congestion_factor")
    shares = readings(spark, sf).groupBy("zona", "hora").agg(
        np_round(share_of(f >= 1.70), 2).alias("pct_alto"),
        np_round(share_of((f >= 1.25) & (f < 1.70)), 2).alias("pct_medio"),
        np_round(share_of(f < 1.25), 2).alias("pct_bajo"),
    )
    return shares.withColumn(
        "nivel_dominante", dominant_level({"pct_alto": "alto", "pct_medio": "medio", "pct_bajo": "bajo"})
    )


# ---- joins --------------------------------------------------------------------


@query(
    "gold_left_join",
    o.ctes(o.SILVER, o.HOURLY, o.CAMERAS_HOURLY, o.FLOW, o.EVENTS_DAILY, o.NEWS_HOURLY, o.GOLD_JOIN) + "SELECT * FROM gold0",
)
def _(spark, sf):
    return join_sources(cleaned(spark, sf))


@query(
    "gold_without_optional",
    o.ctes(o.SILVER, o.HOURLY)
    + """SELECT zona, fecha, hora, dia_semana, temperatura_c, humedad_pct, precipitacion_mm, viento_kmh, codigo_clima,
    congestion_factor, velocidad_kmh, duracion_trafico_s, CAST(NULL AS DOUBLE) AS congestion_ratio, FALSE AS tiene_evento,
    'ninguno' AS tipo_evento, 1.0::DOUBLE AS impacto_factor_evento, CAST(0 AS INTEGER) AS noticias_trafico_cnt, 0.0::DOUBLE AS vehiculos_entrada
    FROM g_cli LEFT JOIN m_cod USING (zona, fecha, hora) LEFT JOIN g_gps USING (zona, fecha, hora)""",
)
def _(spark, sf):
    """Only weather is mandatory; absent sources leave NULLs and defaults."""
    return join_sources(cleaned(spark, sf, "clima", "gps_rutas")).select(
        "zona", "fecha", "hora", "dia_semana", "temperatura_c", "humedad_pct", "precipitacion_mm", "viento_kmh", F.col("codigo_clima").cast("int").alias("codigo_clima"),
        "congestion_factor", "velocidad_kmh", "duracion_trafico_s", "congestion_ratio", "tiene_evento", "tipo_evento",
        "impacto_factor_evento", "noticias_trafico_cnt", "vehiculos_entrada",
    )


@query(
    "full_outer_flow",
    """WITH i AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
    u AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL)
    SELECT l_partkey, l_suppkey, coalesce(i.q, 0) AS v_entrada, coalesce(u.q, 0) AS v_salida FROM i FULL JOIN u USING (l_partkey, l_suppkey)""",
)
def _(spark, sf):
    """One conditional aggregation instead of two passes and an outer join."""
    flag, qty = F.col("l_returnflag"), F.col("l_quantity")
    sides = table(spark, sf, "lineitem").filter(flag.isin("R", "N"))
    return sides.groupBy("l_partkey", "l_suppkey").agg(
        F.coalesce(F.sum(F.when(flag == "R", qty)), F.lit(0.0)).alias("v_entrada"),
        F.coalesce(F.sum(F.when(flag == "N", qty)), F.lit(0.0)).alias("v_salida"),
    )


@query(
    "neighbour_join",
    o.ctes(o.GOLD, o.ADVICE) + "SELECT zona, fecha, hora, alt AS alternativa, c0 AS propio, c1 AS mejor FROM best",
)
def _(spark, sf):
    return with_alternatives(gold(spark, sf)).select(
        "zona",
        "fecha",
        "hora",
        F.col("alt.facts.zona").alias("alternativa"),
        F.col("own.facts.congestion_factor").alias("propio"),
        F.col("alt.usable").alias("mejor"),
    )


@query("best_alternative", o.ctes(o.GOLD, o.ADVICE) + "SELECT zona, alt AS alternativa, count(*) AS veces, min(c1) AS mejor FROM best GROUP BY zona, alt")
def _(spark, sf):
    best = with_alternatives(gold(spark, sf))
    return best.groupBy("zona", F.col("alt.facts.zona").alias("alternativa")).agg(
        F.count(F.lit(1)).alias("veces"), F.min("alt.usable").alias("mejor")
    )


@query("scalar_broadcast", R + "SELECT event_id, v / (SELECT max(v) FROM r) + 1 AS norma FROM r")
def _(spark, sf):
    r = readings(spark, sf).select("event_id", "v")
    return r.select("event_id", (F.col("v") / r.agg(F.max("v")).scalar() + 1).alias("norma"))


@query(
    "expand_all_zones",
    o.ctes(o.CITY_EVENTS, "s_ev AS (SELECT * FROM ev0)", o.EVENTS_DAILY) + "SELECT zona, fecha, nombre, impacto_factor FROM ev_z",
)
def _(spark, sf):
    return ru.to_every_zone(city_events(spark, sf)).select(
        F.col("zona_afectada").alias("zona"), "fecha", "nombre", "impacto_factor"
    )


@query(
    "dense_grid",
    o.ctes(
        o.SILVER, o.HOURLY,
        f"z AS (SELECT unnest({o.sql_list(ZONE_NAMES)}) AS zona)",
        "d AS (SELECT CAST(unnest(generate_series(min(fecha), max(fecha), INTERVAL 1 DAY)) AS DATE) AS fecha FROM r)",
        "h AS (SELECT CAST(unnest(range(24)) AS INTEGER) AS hora)",
    )
    + "SELECT z.zona, d.fecha, h.hora, velocidad_kmh, velocidad_kmh IS NULL AS vacio FROM z, d, h LEFT JOIN g_gps g ON g.zona = z.zona AND g.fecha = d.fecha AND g.hora = h.hora",
)
def _(spark, sf):
    gps = add_time_grain(bronze_sources(spark, sf, ["gps_rutas"])["gps_rutas"])
    span = gps.agg(F.struct(F.min("fecha").alias("a"), F.max("fecha").alias("b"))).scalar()
    grid = se.hour_grid(zone_frame(spark).select("zona"), span["a"], span["b"])
    facts = ru.gps_hourly(add_time_grain(cleaned(spark, sf, "gps_rutas")["gps_rutas"]))
    return se.fill_gaps(facts, grid).select(
        "zona", "fecha", "hora", "velocidad_kmh", F.col("velocidad_kmh").isNull().alias("vacio")
    )


# ---- ordered operators ----------------------------------------------------------


@query("latest_per_zone", o.ctes(o.GOLD, o.LATEST) + "SELECT zona, fecha, hora, congestion_ratio, velocidad_kmh FROM latest")
def _(spark, sf):
    return se.latest_rows(gold(spark, sf)).select("zona", "fecha", "hora", "congestion_ratio", "velocidad_kmh")


@query(
    "lag_trend",
    o.ctes(o.GOLD) + "SELECT zona, fecha, hora, congestion_factor_lag1h, indice_congestion_lag1h, tendencia_congestion FROM gold",
)
def _(spark, sf):
    return gold(spark, sf).select(
        "zona", "fecha", "hora", "congestion_factor_lag1h", "indice_congestion_lag1h", "tendencia_congestion"
    )


_FILL = ["mean_v", "mean_velocidad_kmh"]


@query(
    "circular_fill",
    o.ctes(
        o.READINGS,
        "p AS (SELECT user_id AS zona, hora, round_even(avg(v), 4) AS mean_v, round_even(avg(velocidad_kmh), 4) AS mean_velocidad_kmh FROM r GROUP BY user_id, hora)",
        "g AS (SELECT zona, CAST(unnest(range(24)) AS INTEGER) AS hora FROM (SELECT DISTINCT zona FROM p UNION SELECT c_custkey FROM customer))",
        """nb AS (SELECT g.zona, g.hora, avg(p.mean_v) AS nv, avg(p.mean_velocidad_kmh) AS ns FROM g JOIN p ON p.zona = g.zona
    AND (p.hora - g.hora + 24) % 24 IN (1, 2, 22, 23) GROUP BY g.zona, g.hora)""",
    )
    + """SELECT g.zona AS user_id, g.hora, p.zona IS NOT NULL AS observado,
    round_even(CASE WHEN p.zona IS NOT NULL THEN p.mean_v ELSE nv END, 9) AS mean_v,
    round_even(CASE WHEN p.zona IS NOT NULL THEN p.mean_velocidad_kmh ELSE coalesce(ns, 35.0::DOUBLE) END, 9) AS mean_velocidad_kmh
    FROM g LEFT JOIN p ON p.zona = g.zona AND p.hora = g.hora LEFT JOIN nb ON nb.zona = g.zona AND nb.hora = g.hora""",
)
def _(spark, sf):
    """A profile per user, which leaves hours of the day empty; customers without a reading get the defaults."""
    per_user = readings(spark, sf).groupBy("user_id", "hora").agg(
        np_round(F.avg("v"), 4).alias("mean_v"), np_round(F.avg("velocidad_kmh"), 4).alias("mean_velocidad_kmh")
    )
    everyone = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    filled = se.circular_fill(per_user, _FILL, PROFILE_DEFAULTS, "user_id", everyone)
    return filled.select("user_id", "hora", "observado", *[np_round(c, 9).alias(c) for c in _FILL])


@query(
    "ratio_to_total",
    "WITH s AS (SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name) SELECT n_name, n, n / (SELECT sum(n) FROM s) * 100.0::DOUBLE AS pct FROM s",
)
def _(spark, sf):
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    per_nation = table(spark, sf, "customer").join(nations, "c_nationkey").groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))
    return se.ratio_to_total(per_nation, "n", "pct", 100.0)


# ---- profiles -------------------------------------------------------------------

_PROFILE = ["congestion_ratio", "velocidad_kmh", "congestion_factor"]


@query(
    "profile_zone_hour",
    o.ctes(o.GOLD)
    + "SELECT zona, hora, count(*) AS n, "
    + ", ".join(
        f"coalesce({o.exact(m, 4)}, 0.0::DOUBLE) AS mean_{m}, round_even(greatest(coalesce(stddev_samp({m}), 0.01::DOUBLE), 0.01::DOUBLE), 6) AS std_{m}"
        for m in _PROFILE
    )
    + " FROM gold GROUP BY zona, hora HAVING count(*) >= 2",
)
def _(spark, sf):
    table_ = pf.zone_hour_profile(gold(spark, sf), _PROFILE)
    return table_.withColumns({f"std_{m}": np_round(f"std_{m}", 6) for m in _PROFILE})


def _source_profile(name: str, source: str, silver_name: str):
    """Profile of one source over all zones and hours, with its own defaults and floors."""
    metrics = pf.SOURCE_PROFILES[source]
    columns = []
    for m, (mean, deviation, floor) in metrics.items():
        columns.append(f"coalesce({o.exact(m, 6)}, {mean}::DOUBLE) AS mean_{m}")
        if deviation is not None:
            columns.append(f"round_even(greatest(coalesce(stddev_samp({m}), {deviation}::DOUBLE), {floor}::DOUBLE), 6) AS std_{m}")
    grid = f"z AS (SELECT zona, CAST(unnest(range(24)) AS INTEGER) AS hora FROM (SELECT unnest({o.sql_list(ZONE_NAMES)}) AS zona))"
    sql = o.ctes(o.SILVER, grid) + f"SELECT zona, hora, count(event_id) AS n, {', '.join(columns)} FROM z LEFT JOIN {silver_name} USING (zona, hora) GROUP BY zona, hora"

    @query(name, sql)
    def _(spark, sf):
        rows = add_time_grain(cleaned(spark, sf, source)[source])
        rows = rows.withColumns({m: F.col(m).cast("double") for m in metrics})
        found = pf.source_profile(rows, metrics, zone_frame(spark))
        return found.withColumns({c: np_round(c, 6) for c in found.columns if c.startswith("std_")})


_source_profile("profile_source", "sensores_trafico", "s_sen")
_source_profile("profile_gps", "gps_rutas", "s_gps")
_source_profile("profile_cameras", "vision_camaras", "s_cam")
_source_profile("profile_weather", "clima", "s_cli")


@query(
    "weekday_factor",
    o.ctes(
        o.GOLD,
        f"m AS (SELECT {o.exact('congestion_ratio', 4)} AS a FROM gold)",
        f"d AS (SELECT dia_semana, {o.exact('congestion_ratio', 4)} AS f FROM gold GROUP BY dia_semana)",
        "w AS (SELECT CAST(unnest(range(7)) AS INTEGER) AS dia_semana)",
    )
    + "SELECT w.dia_semana, coalesce(f / nullif((SELECT a FROM m), 0), 1.0::DOUBLE) AS factor FROM w LEFT JOIN d USING (dia_semana)",
)
def _(spark, sf):
    return pf.weekday_factors(gold(spark, sf))


@query(
    "class_probability",
    o.ctes(
        o.GOLD,
        "c AS (SELECT zona, hora, count(*) AS n, count(*) FILTER (WHERE nivel_congestion = 'alto') AS a, count(*) FILTER (WHERE nivel_congestion = 'medio') AS m, count(*) FILTER (WHERE nivel_congestion = 'bajo') AS b FROM gold GROUP BY zona, hora)",
        f"z AS (SELECT zona, CAST(unnest(range(24)) AS INTEGER) AS hora FROM (SELECT unnest({o.sql_list(ZONE_NAMES)}) AS zona))",
        """p AS (SELECT zona, hora, coalesce(n, 0) AS n, CASE WHEN n >= 3 AND a > 0 THEN a / n ELSE 0.33::DOUBLE END AS pa, CASE WHEN n >= 3 AND m > 0 THEN m / n ELSE 0.34::DOUBLE END AS pm,
    CASE WHEN n >= 3 AND b > 0 THEN b / n ELSE 0.33::DOUBLE END AS pb FROM z LEFT JOIN c USING (zona, hora))""",
    )
    + "SELECT zona, hora, n, pa / (pa + pm + pb) AS p_alto, pm / (pa + pm + pb) AS p_medio, pb / (pa + pm + pb) AS p_bajo FROM p",
)
def _(spark, sf):
    return pf.class_probabilities(gold(spark, sf), keys=zone_frame(spark).select("zona"))


_N = len(EVENT_TYPES)
_TYPED = "['deportivo', 'cultural', 'accidente', 'obras', 'otro'][CAST(o_orderkey % 5 AS INTEGER) + 1]"


@query(
    "event_rate",
    f"""WITH e AS (SELECT CAST(o_orderdate AS DATE) AS fecha, {_TYPED} AS tipo FROM orders),
    t AS (SELECT unnest({o.sql_list(EVENT_TYPES)}) AS tipo),
    s AS (SELECT t.tipo, CASE WHEN count(e.tipo) > 0 THEN count(e.tipo) / (SELECT count(tipo) FROM e) ELSE 1.0::DOUBLE / {_N} END AS p FROM t LEFT JOIN e USING (tipo) GROUP BY t.tipo)
    SELECT (SELECT count(*) / greatest(count(DISTINCT fecha) * 6, 1) FROM e) AS prob_evento, (SELECT least(count(*) / greatest(count(DISTINCT fecha) * 6, 1), 0.30::DOUBLE) FROM e) AS prob_acotada, tipo, round_even(p / (SELECT sum(p) FROM s), 9) AS prob_tipo FROM s""",
)
def _(spark, sf):
    tipo = pick(F.col("o_orderkey") % 5, ["deportivo", "cultural", "accidente", "obras", "otro"])
    events = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("fecha"), tipo.alias("tipo"))
    rates = pf.event_rate(events, 6)
    return rates.withColumns({"prob_tipo": np_round("prob_tipo", 9), "prob_acotada": clip("prob_evento", None, 0.30)})


_PS = ", ".join(f"CASE WHEN count(*) FILTER (WHERE sentiment = '{s}') > 0 THEN count(*) FILTER (WHERE sentiment = '{s}') / count(sentiment) ELSE 1.0::DOUBLE / 3 END AS {s}" for s in SENTIMENTS)


@query(
    "news_rate",
    o.ctes(
        o.NEWS,
        f"c AS (SELECT count(*) AS n, count(DISTINCT (fecha, hora)) AS b, count(*) FILTER (WHERE es_trafico) AS tr, {_PS} FROM nw0)",
    )
    + "SELECT n / greatest(b, 1) AS n_por_lote, least(greatest(n / greatest(b, 1), 2.0::DOUBLE), 10.0::DOUBLE) AS n_acotado, tr / n AS pct_trafico, "
    + ", ".join(f"{s} / (positivo + neutro + negativo) AS p_{s}" for s in SENTIMENTS)
    + " FROM c",
)
def _(spark, sf):
    return pf.news_rate(news(spark, sf)).withColumn("n_acotado", clip("n_por_lote", 2.0, 10.0))


