"""SQL text blocks shared by the oracles (DuckDB dialect).

Written from the operator definitions, not generated from the Spark plans.
"""

from __future__ import annotations

from citylake.catalog.views import FIRST_DAY
from citylake.dims import (
    ALTERNATIVES,
    CAPACITY,
    FREE_SPEED,
    HOLIDAY_TYPES,
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
    SIGNAL_IMPACT,
    TRAFFIC_WORDS,
    VEHICLE_SHARES,
    ZONE_NAMES,
    ZONES,
)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(names) -> str:
    return "[" + ", ".join(q(n) for n in names) + "]"


def case(column: str, mapping: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {q(k)} THEN {q(v) if isinstance(v, str) else v}" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {default} END"


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def exact(c: str, digits: int) -> str:
    scale = 10**digits
    return f"(sum(CAST(round_even({c} * {scale}.0::DOUBLE, 0) AS BIGINT))::DOUBLE / NULLIF(count({c}) * {scale}, 0)::DOUBLE)"


def hits(text: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains(lower({text}), {q(w)}) AS INTEGER)" for w in words) + ")"


def relevance_sql(text: str) -> str:
    return f"round_even(least({hits(text, TRAFFIC_WORDS)} / 3.0::DOUBLE, 1.0::DOUBLE), 2)"


def sentiment_sql(text: str) -> str:
    n, p = hits(text, NEGATIVE_WORDS), hits(text, POSITIVE_WORDS)
    return f"CASE WHEN {n} > {p} THEN 'negativo' WHEN {p} > {n} THEN 'positivo' ELSE 'neutro' END"


SERVICE = """CASE WHEN {c} IS NULL THEN NULL WHEN {c} < 0.30 THEN 'A' WHEN {c} < 0.50 THEN 'B' WHEN {c} < 0.65 THEN 'C'
  WHEN {c} < 0.80 THEN 'D' WHEN {c} < 0.95 THEN 'E' ELSE 'F' END"""

READINGS = f"""r0 AS (
  SELECT event_id, user_id, event_type, ts,
    time_bucket(INTERVAL 5 MINUTE, ts) AS ingest_ts,
    {sql_list(ZONE_NAMES)}[CAST(user_id % 6 AS INTEGER) + 1] AS zona,
    CASE WHEN event_id % 2 = 0 THEN 'entrada' ELSE 'salida' END AS posicion,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    floor(value * 64) / 64.0::DOUBLE AS v,
    CAST(ts AS DATE) AS fecha, CAST(hour(ts) AS INTEGER) AS hora, CAST(isodow(ts) - 1 AS INTEGER) AS dia_semana
  FROM events),
r AS (
  SELECT *,
    CASE WHEN k % 7 <> 0 THEN v / 16 + 15 END AS temperatura_c,
    k / 2.0::DOUBLE + 40 AS humedad_pct,
    greatest(v / 32 - 1, 0.0::DOUBLE) AS precipitacion_mm,
    k / 4.0::DOUBLE AS viento_kmh,
    CAST(k % 4 * 15 AS INTEGER) AS codigo_clima,
    CASE WHEN k % 13 <> 0 THEN v / 256 END AS congestion_ratio,
    CAST(floor(v * 10) AS DOUBLE) AS intensidad_veh_hora,
    CASE WHEN k % 11 <> 0 THEN v / 128 + 1 END AS congestion_factor,
    130 - v / 4 AS velocidad_kmh,
    CAST(floor(v * 8) AS DOUBLE) + 300 AS duracion_trafico_s,
    k AS total_detectado
  FROM r0)"""


def counts_sql(total: str) -> str:
    names = list(VEHICLE_SHARES)
    parts = {n: f"CAST(round_even({total} * {VEHICLE_SHARES[n]}::DOUBLE, 0) AS INTEGER)" for n in names[:-1]}
    rest = f"CAST(greatest({total} - ({' + '.join(parts.values())}), 0) AS INTEGER)"
    return ", ".join([f"{e} AS cnt_{n}" for n, e in parts.items()] + [f"{rest} AS cnt_{names[-1]}"])


def dedup(name: str, source: str, key: str, required: str, ranges: str = "TRUE", order: str = "event_id") -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source} WHERE {required}
  ) WHERE rn = 1 AND {ranges})"""


CAMERAS_RAW = f"""cam0 AS (
  SELECT event_id, zona, ingest_ts, fecha, hora, posicion, total_detectado,
    'CAM_' || upper(replace(substr(zona, 1, 6), ' ', '')) || CASE posicion WHEN 'entrada' THEN '_01' ELSE '_02' END AS camara_id,
    {counts_sql('total_detectado')}
  FROM r)"""

CITY_EVENTS = f"""ev0 AS (
  SELECT CAST(DATE '{FIRST_DAY}' + CAST(o_orderkey % 30 AS INTEGER) AS DATE) AS fecha,
    'evento ' || o_orderkey AS nombre,
    CASE WHEN o_orderstatus = 'F' THEN 'todas' ELSE {sql_list([*ZONE_NAMES, 'ninguna'])}[CAST(o_custkey % 7 AS INTEGER) + 1] END AS zona_afectada,
    ['feriado', 'concierto', 'futbol', 'feriado_oficial'][CAST(o_orderkey % 4 AS INTEGER) + 1] AS tipo,
    CASE WHEN o_orderkey % 5 <> 0 THEN ['alta', 'media', 'baja'][CAST(o_custkey % 3 AS INTEGER) + 1] END AS severidad,
    1.0::DOUBLE + (o_orderkey % 80) / 64.0::DOUBLE AS impacto_factor,
    CAST(o_orderkey % 8 AS INTEGER) AS dias_para_evento
  FROM orders)"""

NEWS = f"""nw0 AS (
  SELECT doc_id, substr(md5(source || '/' || (doc_id - doc_id % 2)), 1, 12) AS item_id,
    substr(text, 1, 200) AS titulo,
    {relevance_sql('text')} AS relevance_score,
    {sentiment_sql('text')} AS sentiment,
    CASE WHEN doc_id % 9 <> 0 THEN {relevance_sql('text')} > 0 END AS es_trafico,
    CAST(DATE '{FIRST_DAY}' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS fecha, CAST(doc_id % 24 AS INTEGER) AS hora
  FROM documents)"""

SILVER_CLIMA = dedup("s_cli", "r", "zona, ingest_ts", "temperatura_c IS NOT NULL AND humedad_pct IS NOT NULL")
SILVER_SENSORS = dedup("s_sen", "r", "zona, ingest_ts", "congestion_ratio IS NOT NULL", "congestion_ratio BETWEEN 0 AND 1")
SILVER_GPS = dedup(
    "s_gps", "r", "zona, ingest_ts", "velocidad_kmh IS NOT NULL AND congestion_factor IS NOT NULL",
    "velocidad_kmh BETWEEN 1 AND 130 AND congestion_factor BETWEEN 1 AND 5",
)
SILVER_CAMERAS = dedup("s_cam", "cam0", "camara_id, ingest_ts", "total_detectado IS NOT NULL", "total_detectado >= 0")
SILVER_EVENTS = dedup("s_ev", "ev0", "nombre, fecha", "impacto_factor IS NOT NULL", "impacto_factor BETWEEN 1 AND 2", "nombre")
SILVER_NEWS = dedup("s_nw", "nw0", "item_id", "titulo IS NOT NULL AND relevance_score IS NOT NULL", "relevance_score BETWEEN 0 AND 1", "doc_id")

SILVER = ",\n".join([
    READINGS, CAMERAS_RAW, CITY_EVENTS, NEWS,
    SILVER_CLIMA, SILVER_SENSORS, SILVER_GPS, SILVER_CAMERAS, SILVER_EVENTS, SILVER_NEWS,
])


def mode_sql(name: str, source: str, column: str) -> str:
    return f"""{name} AS (
  SELECT zona, fecha, hora, {column} FROM (
    SELECT zona, fecha, hora, {column}, row_number() OVER (PARTITION BY zona, fecha, hora ORDER BY count(*) DESC, {column}) AS rn
    FROM {source} WHERE {column} IS NOT NULL GROUP BY zona, fecha, hora, {column}) WHERE rn = 1)"""


HOURLY = ",\n".join([
    mode_sql("m_cod", "s_cli", "codigo_clima"),
    f"""s_sen2 AS (SELECT *, {SERVICE.format(c='congestion_ratio')} AS nivel_servicio FROM s_sen)""",
    mode_sql("m_niv", "s_sen2", "nivel_servicio"),
    """g_cli AS (
  SELECT zona, fecha, hora, CAST(isodow(fecha) - 1 AS INTEGER) AS dia_semana,
    round_even(avg(temperatura_c), 2) AS temperatura_c, round_even(avg(humedad_pct), 2) AS humedad_pct,
    round_even(avg(precipitacion_mm), 2) AS precipitacion_mm, round_even(avg(viento_kmh), 2) AS viento_kmh
  FROM s_cli GROUP BY zona, fecha, hora)""",
    """g_sen AS (
  SELECT zona, fecha, hora, round_even(avg(congestion_ratio), 3) AS congestion_ratio,
    round_even(avg(intensidad_veh_hora), 3) AS intensidad_veh_hora
  FROM s_sen GROUP BY zona, fecha, hora)""",
    """g_gps AS (
  SELECT zona, fecha, hora, round_even(avg(congestion_factor), 3) AS congestion_factor,
    round_even(avg(velocidad_kmh), 3) AS velocidad_kmh, round_even(avg(duracion_trafico_s), 3) AS duracion_trafico_s
  FROM s_gps GROUP BY zona, fecha, hora)""",
])

_C = ["cnt_" + n for n in VEHICLE_SHARES]
CAMERAS_HOURLY = f"""g_cam0 AS (
  SELECT zona, fecha, hora, ingest_ts, sum(total_detectado) AS total_detectado, {', '.join(f'sum({c}) AS {c}' for c in _C)}
  FROM s_cam GROUP BY zona, fecha, hora, ingest_ts),
g_cam1 AS (
  SELECT zona, fecha, hora, round_even(avg(total_detectado), 1) AS total_vehiculos_zona,
    {', '.join(f'round_even(avg({c}), 1) AS {c}' for c in _C)}
  FROM g_cam0 GROUP BY zona, fecha, hora),
g_cam2 AS (SELECT *, {' + '.join(_C)} AS t FROM g_cam1),
g_cam AS (
  SELECT zona, fecha, hora, total_vehiculos_zona,
    {', '.join(f"round_even({c} / nullif(t, 0) * 100, 1) AS pct_{c[4:]}" for c in _C)},
    round_even(round_even(cnt_bus / nullif(t, 0) * 100, 1) + round_even(cnt_combi_minibus / nullif(t, 0) * 100, 1), 1) AS pct_transporte_publico
  FROM g_cam2)"""

FLOW = """f_in AS (
  SELECT zona, fecha, hora, ingest_ts, sum(total_detectado) AS n FROM s_cam WHERE posicion = 'entrada' GROUP BY ALL),
f_out AS (
  SELECT zona, fecha, hora, ingest_ts, sum(total_detectado) AS n FROM s_cam WHERE posicion = 'salida' GROUP BY ALL),
g_flow AS (
  SELECT zona, fecha, hora, round_even(avg(coalesce(f_in.n, 0)), 1) AS vehiculos_entrada,
    round_even(avg(coalesce(f_out.n, 0)), 1) AS vehiculos_salida
  FROM f_in FULL JOIN f_out USING (zona, fecha, hora, ingest_ts) GROUP BY zona, fecha, hora)"""

EVENTS_DAILY = f"""ev_z AS (
  SELECT * EXCLUDE (zona_afectada), zona_afectada AS zona FROM s_ev WHERE zona_afectada <> 'todas'
  UNION ALL BY NAME
  SELECT s_ev.* EXCLUDE (zona_afectada), z.zona FROM s_ev, (SELECT unnest({sql_list(ZONE_NAMES)}) AS zona) z WHERE zona_afectada = 'todas'),
g_ev AS (
  SELECT zona, fecha, impacto_factor AS impacto_factor_evento, tipo AS tipo_evento, severidad, TRUE AS tiene_evento,
    coalesce(tipo IN ({', '.join(q(t) for t in HOLIDAY_TYPES)}), FALSE) AS es_feriado
  FROM (SELECT *, row_number() OVER (PARTITION BY zona, fecha ORDER BY impacto_factor DESC, nombre) AS w FROM ev_z) WHERE w = 1)"""

NEWS_HOURLY = """g_nw AS (
  SELECT fecha, hora, CAST(count(*) FILTER (WHERE coalesce(es_trafico, FALSE)) AS INTEGER) AS noticias_trafico_cnt,
    CAST(count(*) FILTER (WHERE sentiment = 'negativo') AS INTEGER) AS sentimiento_negativo_cnt,
    max(relevance_score) AS relevance_score_max
  FROM s_nw GROUP BY fecha, hora)"""

PERIOD = """CASE WHEN hora <= 5 THEN 'madrugada' WHEN hora <= 11 THEN 'manana' WHEN hora <= 16 THEN 'tarde'
    WHEN hora <= 20 THEN 'noche_temprana' ELSE 'noche' END"""

LEVEL = """CASE WHEN {f} IS NOT NULL THEN CASE WHEN {f} < 1.25 THEN 'bajo' WHEN {f} < 1.70 THEN 'medio' ELSE 'alto' END
    ELSE CASE WHEN {i} < 1.25 THEN 'bajo' WHEN {i} < 1.60 THEN 'medio' ELSE 'alto' END END"""

INDEX = """round_even(coalesce({f}, 1.0::DOUBLE) * 0.60::DOUBLE + (coalesce({r}, 0.0::DOUBLE) + 1.0::DOUBLE) * 0.30::DOUBLE
      + (CASE WHEN {m} > 0 THEN coalesce({v}, 0.0::DOUBLE) / {m} + 1.0::DOUBLE ELSE 1.0::DOUBLE END) * 0.10::DOUBLE, 3)"""

GOLD_JOIN = """gold0 AS (
  SELECT * REPLACE (
    coalesce(tiene_evento, FALSE) AS tiene_evento, coalesce(es_feriado, FALSE) AS es_feriado,
    coalesce(impacto_factor_evento, 1.0::DOUBLE) AS impacto_factor_evento, coalesce(tipo_evento, 'ninguno') AS tipo_evento,
    coalesce(severidad, 'ninguna') AS severidad, coalesce(noticias_trafico_cnt, 0) AS noticias_trafico_cnt,
    coalesce(sentimiento_negativo_cnt, 0) AS sentimiento_negativo_cnt, coalesce(relevance_score_max, 0.0::DOUBLE) AS relevance_score_max,
    coalesce(vehiculos_entrada, 0.0::DOUBLE) AS vehiculos_entrada, coalesce(vehiculos_salida, 0.0::DOUBLE) AS vehiculos_salida)
  FROM g_cli LEFT JOIN m_cod USING (zona, fecha, hora) LEFT JOIN g_sen USING (zona, fecha, hora)
    LEFT JOIN m_niv USING (zona, fecha, hora) LEFT JOIN g_gps USING (zona, fecha, hora)
    LEFT JOIN g_cam USING (zona, fecha, hora) LEFT JOIN g_flow USING (zona, fecha, hora)
    LEFT JOIN g_ev USING (zona, fecha) LEFT JOIN g_nw USING (fecha, hora))"""

GOLD_FEATURES = f"""gold1 AS (
  SELECT *, (SELECT max(total_vehiculos_zona) FROM gold0) AS cam_max FROM gold0),
gold2 AS (
  SELECT * EXCLUDE (cam_max),
    round_even(sin(hora * (2 * pi()) / 24), 4) AS hora_sin, round_even(cos(hora * (2 * pi()) / 24), 4) AS hora_cos,
    CAST(hora IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS es_hora_punta, CAST(dia_semana >= 5 AS INTEGER) AS es_fin_de_semana,
    {PERIOD} AS periodo_dia,
    CAST(coalesce(precipitacion_mm > 0.5, FALSE) AS INTEGER) AS lluvia_flag,
    CAST(coalesce(precipitacion_mm > 5.0, FALSE) AS INTEGER) AS lluvia_intensa,
    {INDEX.format(f='congestion_factor', r='congestion_ratio', v='total_vehiculos_zona', m='cam_max')} AS indice_congestion,
    CASE WHEN velocidad_kmh IS NOT NULL THEN least(greatest(round_even(velocidad_kmh / {case('zona', FREE_SPEED)}::DOUBLE, 3), 0.0::DOUBLE), 1.5::DOUBLE) END AS velocidad_relativa,
    round_even(impacto_factor_evento - 1.0::DOUBLE, 3) AS presion_evento,
    round_even(least(greatest(vehiculos_entrada / (CASE WHEN vehiculos_salida = 0 THEN 1.0::DOUBLE ELSE vehiculos_salida END), 0.3::DOUBLE), 3.0::DOUBLE), 3) AS ratio_flujo_camara
  FROM gold1),
gold3 AS (
  SELECT *, lag(congestion_factor) OVER w AS lag_cf, lag(indice_congestion) OVER w AS lag_ix
  FROM gold2 WINDOW w AS (PARTITION BY zona ORDER BY fecha, hora)),
gold AS (
  SELECT * EXCLUDE (lag_cf, lag_ix) REPLACE (CAST(tiene_evento AS INTEGER) AS tiene_evento, CAST(es_feriado AS INTEGER) AS es_feriado),
    coalesce(lag_cf, congestion_factor) AS congestion_factor_lag1h,
    coalesce(lag_ix, indice_congestion) AS indice_congestion_lag1h,
    coalesce(round_even(indice_congestion - lag_ix, 3), 0.0::DOUBLE) AS tendencia_congestion,
    {LEVEL.format(f='congestion_factor', i='indice_congestion')} AS nivel_congestion
  FROM gold3)"""

GOLD = ",\n".join([SILVER, HOURLY, CAMERAS_HOURLY, FLOW, EVENTS_DAILY, NEWS_HOURLY, GOLD_JOIN, GOLD_FEATURES])

_EDGES = ", ".join(f"({q(z)}, {q(a)}, {i})" for z, alts in ALTERNATIVES.items() for i, a in enumerate(alts))
ADVICE = f"""edges AS (SELECT * FROM (VALUES {_EDGES}) t(zona, alt, prio)),
cand AS (
  SELECT o.zona, o.fecha, o.hora, o.nivel_congestion AS n0, o.congestion_factor AS c0, o.indice_congestion AS i0,
    o.velocidad_kmh AS v0, o.duracion_trafico_s AS d0,
    e.alt, a.nivel_congestion AS n1, a.velocidad_kmh AS v1, a.duracion_trafico_s AS d1,
    CASE WHEN a.congestion_factor = 0 THEN a.indice_congestion ELSE a.congestion_factor END AS c1, e.prio
  FROM gold o JOIN edges e ON e.zona = o.zona
    JOIN gold a ON a.zona = e.alt AND a.fecha = o.fecha AND a.hora = o.hora),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY zona, fecha, hora ORDER BY c1, prio) AS rn FROM cand WHERE c1 IS NOT NULL) WHERE rn = 1),
advice AS (
  SELECT zona, fecha, hora, n0 AS nivel_congestion_actual, round_even(c0, 3) AS congestion_factor_actual,
    round_even(v0, 1) AS velocidad_actual_kmh, alt AS ruta_alternativa, n1 AS nivel_alternativa,
    round_even(c1, 3) AS congestion_factor_alt, round_even(v1, 1) AS velocidad_alt_kmh,
    round_even(CASE WHEN d0 IS NULL OR d1 IS NULL THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, (d0 - d1) / 60) END, 1) AS ahorro_estimado_min,
    CASE WHEN coalesce(c1 < (CASE WHEN c0 = 0 THEN i0 ELSE c0 END), FALSE) AND n1 <> 'alto' THEN 'RECOMENDADA' ELSE 'ALTERNATIVA_POSIBLE' END AS estado
  FROM best)"""

_ACTION = "CASE WHEN ratio_flujo_camara > 1.20 THEN 'ampliar_verde' WHEN ratio_flujo_camara < 0.80 THEN 'reducir_verde' ELSE 'mantener' END"
SIGNALS = f"""sig0 AS (
  SELECT *, CAST(round_even(least(greatest(ratio_flujo_camara * 60, 30.0::DOUBLE), 120.0::DOUBLE), 0) AS INTEGER) AS verde_recomendado_s,
    {_ACTION} AS accion_semaforo
  FROM gold),
signals AS (
  SELECT zona, fecha, hora, nivel_congestion, vehiculos_entrada, vehiculos_salida, ratio_flujo_camara, congestion_factor,
    indice_congestion, CAST({case('zona', CAPACITY)} AS INTEGER) AS capacidad_ref, verde_recomendado_s,
    CAST(60 AS INTEGER) AS verde_actual_estimado_s, CAST(verde_recomendado_s - 60 AS INTEGER) AS ajuste_verde_s, accion_semaforo,
    {case('accion_semaforo', SIGNAL_IMPACT)} AS impacto_estimado
  FROM sig0)"""

KPI_ZONE = f"""kz0 AS (
  SELECT zona, round_even({exact('velocidad_kmh', 3)}, 2) AS velocidad_kmh, round_even({exact('congestion_ratio', 3)}, 2) AS congestion_ratio,
    round_even({exact('intensidad_veh_hora', 3)}, 2) AS intensidad_veh_hora, round_even({exact('total_vehiculos_zona', 1)}, 2) AS total_vehiculos,
    {', '.join(f"round_even(count(*) FILTER (WHERE nivel_congestion = {q(v)})::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE, 2) AS pct_{v}" for v in ('alto', 'medio', 'bajo'))},
    count(velocidad_kmh) AS registros
  FROM gold GROUP BY zona),
kpi_zone AS (
  SELECT *, CAST({case('zona', {z.name: z.lat for z in ZONES})} AS DOUBLE) AS lat, CAST({case('zona', {z.name: z.lon for z in ZONES})} AS DOUBLE) AS lon,
    CASE WHEN pct_alto >= pct_medio AND pct_alto >= pct_bajo THEN 'alto' WHEN pct_medio >= pct_bajo THEN 'medio' ELSE 'bajo' END AS nivel_dominante
  FROM kz0)"""

LATEST = """latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY zona ORDER BY fecha DESC, hora DESC) AS rn FROM gold) WHERE rn = 1)"""

KPI_GLOBAL = f"""kg AS (
  SELECT {exact('velocidad_kmh', 3)} AS vel, {exact('congestion_ratio', 3)} AS cr,
    {', '.join(f"count(*) FILTER (WHERE nivel_congestion = {q(v)})::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE AS p_{v}" for v in ('alto', 'medio', 'bajo'))},
    CAST(sum(tiene_evento) AS BIGINT) AS ev
  FROM gold),
kl AS (SELECT arg_min(zona, (-congestion_ratio, zona)) FILTER (WHERE congestion_ratio IS NOT NULL) AS worst, min(velocidad_kmh) AS slow FROM latest),
kpi_global AS (
  SELECT 'Velocidad promedio (km/h)' AS KPI, CAST(round_even(vel, 1) AS VARCHAR) AS Valor, 'km/h' AS Unidad FROM kg
  UNION ALL SELECT 'Congestión global (ratio)', CAST(round_even(cr, 3) AS VARCHAR), 'ratio 0-1' FROM kg
  UNION ALL SELECT '% Nivel ALTO', CAST(round_even(p_alto, 1) AS VARCHAR), '%' FROM kg
  UNION ALL SELECT '% Nivel MEDIO', CAST(round_even(p_medio, 1) AS VARCHAR), '%' FROM kg
  UNION ALL SELECT '% Nivel BAJO', CAST(round_even(p_bajo, 1) AS VARCHAR), '%' FROM kg
  UNION ALL SELECT 'Zona más congestionada', worst, 'texto' FROM kl
  UNION ALL SELECT 'Velocidad mínima zona crítica (km/h)', CAST(round_even(slow, 1) AS VARCHAR), 'km/h' FROM kl
  UNION ALL SELECT 'Registros con evento activo', CAST(ev AS VARCHAR), 'registros' FROM kg)"""

KPI_HOUR = f"""kpi_hour AS (
  SELECT hora, round_even({exact('velocidad_kmh', 3)}, 3) AS velocidad_kmh, round_even({exact('congestion_ratio', 3)}, 3) AS congestion_ratio,
    round_even({exact('intensidad_veh_hora', 3)}, 3) AS intensidad_veh_hora,
    round_even(count(*) FILTER (WHERE nivel_congestion = 'alto')::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE, 3) AS pct_alto,
    printf('%02d:00', hora) AS hora_label, CAST(hora IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS es_hora_punta
  FROM gold GROUP BY hora)"""

_VT = {"auto_taxi": "Auto/Taxi", "combi_minibus": "Combi/Minibus", "moto_mototaxi": "Moto/Mototaxi", "bus": "Bus", "camioneta_lgv": "Camioneta/LGV", "camion_hgv": "Camion/HGV"}
KPI_COMPOSITION = f"""kc0 AS (
  SELECT {', '.join(f"round_even({exact('pct_' + c, 1)}, 2) AS {c}" for c in _VT)} FROM gold),
kc1 AS (SELECT *, {' + '.join(f'coalesce({c}, 0.0::DOUBLE)' for c in _VT)} AS t FROM kc0),
kpi_composition AS (
  {' UNION ALL '.join(f"SELECT {q(label)} AS tipo_vehiculo, {c} AS porcentaje, round_even({c} / t * 100, 2) AS porcentaje_norm FROM kc1" for c, label in _VT.items())})"""
