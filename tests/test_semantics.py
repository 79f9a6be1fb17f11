"""Edge rows for each semantic decision: missing values, rounding, ties, gaps, defaults."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from citylake.dims import VEHICLE_SHARES
from citylake.functions import numeric as nm
from citylake.functions import text as tx
from citylake.functions import traffic as tf
from citylake.operators import kpi, measures
from citylake.operators import profile as pf
from citylake.operators import quality as ql
from citylake.operators import rollup as ru
from citylake.operators import series as se
from citylake.operators.advise import route_advice, signal_timing
from citylake.operators.upsert import newest_wins
from citylake.plans.gold import congestion_by_zone
from citylake.plans.silver import RULES
from citylake.sources import agenda, payloads

DAY = datetime.date(2026, 6, 28)
Z1, Z2, Z3 = "Via Expresa - Centro", "Javier Prado - San Isidro", "Av. Brasil - Magdalena"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str) if columns else df.collect()


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head().x


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([("a", math.nan), ("a", None), ("a", 2.0)], "zona string, x double")
    out = nm.nan_to_null(df).groupBy("zona").agg(F.avg("x").alias("m"), F.count("x").alias("n")).head()
    assert (out.m, out.n) == (2.0, 1)
    flagged = nm.nan_to_null(df).select(tf.rain_flag(F.col("x"), 0.5).alias("f"))
    assert [r.f for r in flagged.collect()] == [False, False, True]


@pytest.mark.parametrize(
    ("value", "digits", "want"),
    [(0.125, 2, 0.12), (2.5, 0, 2.0), (1.005, 2, 1.0), (1.015, 2, 1.01), (-0.125, 2, -0.12), (-2.5, 0, -2.0)],
)
def test_rounding_follows_numpy(spark, value, digits, want):
    import numpy as np

    assert float(np.round(value, digits)) == want
    assert one(spark, nm.np_round(F.lit(value), digits)) == want


def test_clip_keeps_null(spark):
    assert one(spark, nm.clip(F.lit(None).cast("double"), 0.0, 1.5)) is None
    assert one(spark, nm.clip(F.lit(9.0), 0.0, 1.5)) == 1.5


def test_lenient_int(spark):
    df = spark.createDataFrame([("2.5",), ("3.5",), ("x",), (None,), ("NaN",)], "c string")
    assert [r.c for r in df.select(nm.lenient_int("c").alias("c")).collect()] == [2, 4, None, None, None]


def test_bad_first_duplicate_evicts_the_good_one(spark):
    ts = datetime.datetime(2026, 6, 28, 10)
    df = spark.createDataFrame(
        [("a", ts, 1, 500.0, 2.0), ("a", ts, 2, 50.0, 2.0), ("b", ts, 3, 60.0, 2.0)],
        "zona string, _ingest_ts timestamp, id int, velocidad_kmh double, congestion_factor double",
    )
    assert rows(ql.clean(df, RULES["gps_rutas"], ["id"]), "zona", "id") == [("b", 3)]


def test_clean_is_idempotent(spark):
    ts = datetime.datetime(2026, 6, 28, 10)
    df = spark.createDataFrame(
        [("a", ts, i, 40.0 + i, 2.0) for i in range(5)],
        "zona string, _ingest_ts timestamp, id int, velocidad_kmh double, congestion_factor double",
    )
    once = ql.clean(df, RULES["gps_rutas"])
    assert rows(ql.clean(once, RULES["gps_rutas"]), *once.columns) == rows(once, *once.columns)


def test_news_flag_null_is_false(spark):
    df = spark.createDataFrame(
        [("1", "t", 0.5, None), ("2", "t", 0.5, True)], "item_id string, titulo string, relevance_score double, es_trafico boolean"
    )
    assert rows(ql.clean(df, RULES["redes_noticias"], ["item_id"]), "item_id", "es_trafico") == [("1", False), ("2", True)]


def events(spark, data):
    return spark.createDataFrame(
        data, "zona_afectada string, fecha date, impacto_factor double, nombre string, tipo string, severidad string"
    )


def test_event_tie_gives_one_whole_row(spark):
    df = events(spark, [(Z1, DAY, 1.45, "b", "futbol", "alta"), (Z1, DAY, 1.45, "a", "feriado", None)])
    got = ru.strongest_events(df).head()
    assert (got.tipo_evento, got.severidad, got.es_feriado) == ("feriado", None, True)


def test_city_wide_events_reach_every_zone_and_unknown_zones_stay(spark):
    df = events(
        spark,
        [("todas", DAY, 1.2, "n", "feriado_oficial", "media"), ("ninguna", DAY, 1.0, "s", "ninguno", "ninguna"), (Z1, DAY, 1.45, "p", "procesion", "alta")],
    )
    got = {r.zona: r.tipo_evento for r in ru.strongest_events(df).collect()}
    assert len(got) == 7 and got[Z1] == "procesion" and got[Z2] == "feriado_oficial" and got["ninguna"] == "ninguno"


def test_newest_wins_and_keeps_both_sides_columns(spark):
    old = spark.createDataFrame([(Z1, DAY, 3, 1.0, "x"), (Z1, DAY, 4, 1.5, "y")], "zona string, fecha date, hora int, v double, solo_hist string")
    new = spark.createDataFrame([(Z1, DAY, 3, 2.0, 7)], "zona string, fecha date, hora int, v double, solo_nuevo int")
    wide = newest_wins([old, new])
    assert rows(wide, "hora", "v", "solo_hist", "solo_nuevo") == [(3, 2.0, None, 7), (4, 1.5, "y", None)]
    narrow = newest_wins([old, new], common=True)
    assert set(narrow.columns) == {"zona", "fecha", "hora", "v"}
    again = newest_wins([wide, new])
    assert rows(again, "hora", "v") == rows(wide, "hora", "v")


def test_latest_row_uses_the_hour(spark):
    df = spark.createDataFrame([(Z1, DAY, 3, 1.0), (Z1, DAY, 21, 2.0)], "zona string, fecha date, hora int, v double")
    assert rows(se.latest_rows(df), "hora", "v") == [(21, 2.0)]


def test_circular_fill_uses_observed_neighbours_only(spark):
    df = spark.createDataFrame([("a", 0, 10.0), ("a", 1, 20.0), ("a", 5, 50.0)], "zona string, hora int, m double")
    got = {r.hora: (r.observado, r.m) for r in se.circular_fill(df, ["m"], {"m": -1.0}).collect()}
    assert len(got) == 24
    assert got[0] == (True, 10.0)
    assert got[2] == (False, 15.0)
    assert got[3] == (False, 35.0)
    assert got[23] == (False, 15.0)
    assert got[22] == (False, 10.0)
    assert got[12] == (False, -1.0)


def test_mode_ties_and_all_null(spark):
    df = spark.createDataFrame(
        [("a", DAY, 1, c) for c in (3, 1, 3, 1, None)] + [("b", DAY, 1, None)], "zona string, fecha date, hora int, c int"
    )
    assert rows(ru.hourly(df, [], ["c"]), "zona", "c") == [("a", 1), ("b", None)]


def test_lag_is_the_previous_row_across_gaps(spark):
    df = spark.createDataFrame(
        [("a", DAY, 7, 1.0, 1.1), ("a", DAY, 9, 2.0, 1.4), ("a", DAY, 10, None, 1.2)],
        "zona string, fecha date, hora int, congestion_factor double, indice_congestion double",
    )
    got = {r.hora: r for r in se.lag_features(df).collect()}
    assert (got[7].congestion_factor_lag1h, got[7].tendencia_congestion) == (1.0, 0.0)
    assert (got[9].congestion_factor_lag1h, got[9].tendencia_congestion) == (1.0, 0.3)
    assert (got[10].congestion_factor_lag1h, got[10].tendencia_congestion) == (2.0, -0.2)


def test_incremental_lags_equal_full_lags(spark):
    data = [(z, DAY + datetime.timedelta(days=d), h, 1.0 + d + h / 10, 1.0 + h / 7) for z in ("a", "b") for d in range(3) for h in (1, 5, 23)]
    full = spark.createDataFrame(data, "zona string, fecha date, hora int, congestion_factor double, indice_congestion double")
    since = F.lit(DAY + datetime.timedelta(days=2))
    fresh, past = full.filter(F.col("fecha") >= since), full.filter(F.col("fecha") < since)
    columns = ["zona", "fecha", "hora", "congestion_factor_lag1h", "indice_congestion_lag1h", "tendencia_congestion"]
    want = se.lag_features(full).filter(F.col("fecha") >= since)
    stored = [DAY + datetime.timedelta(days=d) for d in range(2)]
    assert rows(se.lag_features_incremental(fresh, past, stored), *columns) == rows(want, *columns)


def test_carried_rows_reach_back_only_for_zones_not_found(spark):
    day = lambda d: DAY + datetime.timedelta(days=d)
    data = [("a", day(d), 5, 1.0 + d) for d in range(20)] + [("b", day(3), 7, 9.0)]
    past = spark.createDataFrame(data, "zona string, fecha date, hora int, congestion_factor double")
    stored = [day(d) for d in range(20)]
    a, b = (spark.createDataFrame([(z,)], "zona string") for z in "ab")
    near = se.last_rows(past, a, stored)
    assert rows(near, "zona", "fecha") == [("a", day(19))]
    assert str(day(19)) in near._jdf.queryExecution().optimizedPlan().toString()  # one day only
    assert rows(se.last_rows(past, b, stored), "zona", "fecha") == [("a", day(19)), ("b", day(3))]
    assert rows(se.last_rows(past, b, []), "zona") == []


def gold_rows(spark, data):
    return spark.createDataFrame(
        [(z, DAY, 8, cf, ix, lv, v, d) for z, cf, ix, lv, v, d in data],
        "zona string, fecha date, hora int, congestion_factor double, indice_congestion double, nivel_congestion string, velocidad_kmh double, duracion_trafico_s double",
    )


def test_route_advice_ties_nulls_and_status(spark):
    df = gold_rows(
        spark,
        [(Z1, 2.0, 1.5, "alto", 20.0, 1200.0), (Z2, 1.3, 1.3, "medio", 30.0, 600.0), (Z3, 1.3, 1.3, "medio", 35.0, None)],
    )
    got = {r.zona: r for r in route_advice(df).collect()}
    assert got[Z1].ruta_alternativa == Z2  # first listed wins the tie
    assert (got[Z1].ahorro_estimado_min, got[Z1].estado) == (10.0, "RECOMENDADA")
    assert got[Z3].ruta_alternativa == Z1 and got[Z3].ahorro_estimado_min == 0.0 and got[Z3].estado == "ALTERNATIVA_POSIBLE"
    without = gold_rows(spark, [(Z1, None, 1.5, "alto", 20.0, 1.0), (Z2, None, 1.3, "medio", 30.0, 1.0), (Z3, 1.4, 1.3, "medio", 35.0, 1.0)])
    got = {r.zona: r for r in route_advice(without).collect()}
    assert got[Z1].ruta_alternativa == Z3  # a null factor never wins
    assert got[Z1].estado == "ALTERNATIVA_POSIBLE"  # own factor unknown
    assert Z2 not in got  # its only measured alternatives are null or absent


def test_flow_ratio_guards(spark):
    assert one(spark, tf.flow_ratio(F.lit(8.0), F.lit(0.0))) == 3.0
    assert one(spark, tf.flow_ratio(F.lit(0.0), F.lit(8.0))) == 0.3
    assert one(spark, tf.flow_ratio(F.lit(1.0), F.lit(3.0))) == 0.333


def test_label_edges(spark):
    df = spark.createDataFrame(
        [(1.2499, 9.0), (1.25, 9.0), (1.7, 1.0), (None, 1.2499), (None, 1.25), (None, 1.6)], "f double, i double"
    )
    got = [r.n for r in df.select(tf.congestion_level(F.col("f"), F.col("i")).alias("n")).collect()]
    assert got == ["bajo", "medio", "alto", "bajo", "medio", "alto"]


def test_service_level_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.2999, 0.30, 0.5, 0.65, 0.80, 0.95)], "r double")
    assert "".join(r.s for r in df.select(tf.service_level(F.col("r")).alias("s")).collect()) == "ABCDEF"


def test_shares_sum_to_hundred_and_empty_rows_have_none(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 30.0, 10.0)], "id int, cnt_bus double, cnt_combi_minibus double")
    got = {r.id: r for r in ru.class_shares(df, ["cnt_bus", "cnt_combi_minibus"]).collect()}
    assert got[1].pct_bus is None and got[1].pct_transporte_publico is None
    assert (got[2].pct_bus, got[2].pct_combi_minibus, got[2].pct_transporte_publico) == (75.0, 25.0, 100.0)


@pytest.mark.parametrize("total", [0, 1, 7, 100, 9999])
def test_allocation_sums_to_total_unless_floored(spark, total):
    parts = spark.range(1).select(*nm.proportional_counts(F.lit(total), VEHICLE_SHARES)).head()
    assert min(parts) >= 0
    rounded = sum(parts[:-1])
    assert sum(parts) == max(total, rounded)


def test_camera_two_levels_and_one_sided_batches(spark):
    hour = [
        ("a", DAY, 8, "t1", "entrada", 10, 10),
        ("a", DAY, 8, "t1", "salida", 20, 20),
        ("a", DAY, 8, "t2", "entrada", 30, 30),
        ("a", DAY, 8, "t3", "otra", 99, 99),
    ]
    df = spark.createDataFrame(hour, "zona string, fecha date, hora int, lote string, posicion string, total_detectado int, cnt_bus int")
    got = ru.cameras_hourly(df, "lote").head()
    assert got.total_vehiculos_zona == round((30 + 30 + 99) / 3, 1)
    assert (got.vehiculos_entrada, got.vehiculos_salida) == (20.0, 10.0)


def weather(spark, hours=(7, 8)):
    return spark.createDataFrame(
        [(Z1, datetime.datetime(2026, 6, 28, h), 20.0, 70.0, 1.0, 5.0, 0) for h in hours],
        "zona string, _ingest_ts timestamp, temperatura_c double, humedad_pct double, precipitacion_mm double, viento_kmh double, codigo_clima int",
    )


def test_gold_from_weather_alone(spark):
    got = congestion_by_zone({"clima": weather(spark)}).orderBy("hora").collect()
    assert [r.nivel_congestion for r in got] == ["bajo", "bajo"]
    first = got[0]
    assert (first.indice_congestion, first.tipo_evento, first.tiene_evento, first.congestion_factor) == (1.0, "ninguno", 0, None)
    assert (first.lluvia_flag, first.lluvia_intensa, first.es_fin_de_semana, first.dia_semana) == (1, 0, 1, 6)
    with pytest.raises(ValueError):
        congestion_by_zone({})


def test_gold_timezone_moves_the_hour(spark):
    got = congestion_by_zone({"clima": weather(spark, (2,))}, tz="America/Lima").head()
    assert (got.hora, got.fecha) == (21, DAY - datetime.timedelta(days=1))


def test_signal_bounds(spark):
    df = spark.createDataFrame([(0.3,), (1.0,), (1.2,), (1.25,), (3.0,)], "ratio_flujo_camara double")
    extra = {c: F.lit(None).cast("double") for c in ("vehiculos_entrada", "vehiculos_salida", "congestion_factor", "indice_congestion")}
    gold = df.withColumns(extra).withColumns(
        {"zona": F.lit(Z1), "fecha": F.lit(DAY), "hora": F.lit(1), "nivel_congestion": F.lit("bajo")}
    )
    got = [(r.verde_recomendado_s, r.ajuste_verde_s, r.accion_semaforo) for r in signal_timing(gold).orderBy("ratio_flujo_camara").collect()]
    assert got == [(30, -30, "reducir_verde"), (60, 0, "mantener"), (72, 12, "mantener"), (75, 15, "ampliar_verde"), (120, 60, "ampliar_verde")]


def test_agenda_window_and_sentinel(spark):
    today = datetime.date(2026, 7, 1)
    day = lambda n: today + datetime.timedelta(days=n)
    calendar = spark.createDataFrame(
        [(day(n), f"e{n}", "futbol", Z1, s) for n, s in ((-1, "alta"), (0, "alta"), (7, "rara"), (8, "baja"))],
        "fecha date, nombre string, tipo string, zona_afectada string, severidad string",
    )
    none = spark.createDataFrame([], "fecha date, nombre string")
    got = rows(agenda.agenda(none, calendar, F.lit(today)), "nombre", "impacto_factor", "dias_para_evento")
    assert got == [("e0", 1.45, 0), ("e7", 1.0, 7)]
    quiet = agenda.agenda(none, calendar, F.lit(day(60))).collect()
    assert [(r.nombre, r.zona_afectada, r.impacto_factor) for r in quiet] == [("Sin eventos relevantes", "ninguna", 1.0)]


def test_trip_payload_statuses(spark):
    def answer(outer, inner, traffic, free=100):
        t = f', "duration_in_traffic": {{"value": {traffic}}}' if traffic is not None else ""
        return f'{{"status": "{outer}", "rows": [{{"elements": [{{"status": "{inner}", "distance": {{"value": 1000}}, "duration": {{"value": {free}}}{t}}}]}}]}}'

    data = [("ok", answer("OK", "OK", 150)), ("outer", answer("DENIED", "OK", 1)), ("inner", answer("OK", "NONE", 1)), ("plain", answer("OK", "OK", None)), ("zero", answer("OK", "OK", 0, 0)), ("junk", "{{")]
    df = spark.createDataFrame(data, "id string, p string")
    got = rows(payloads.trips(df, "p", "id"), "id", "congestion_factor", "velocidad_kmh", "duracion_trafico_s")
    assert got == [("ok", 1.5, 24.0, 150), ("plain", 1.0, 36.0, 100), ("zero", 1.0, 0.0, 0)]


def test_feed_items(spark):
    feed = """<rss><title>Canal</title><description>c</description><link>https://c.example/</link>
    <item><title><![CDATA[ Choque en la <b>avenida</b> ]]></title><description>Cierre   parcial</description><link>https://c.example/1</link><pubDate>lunes</pubDate></item>
    <item><title>  </title><description>x</description><link>https://c.example/2</link><pubDate>martes</pubDate></item>
    <item><title>Sin enlace</title><description>y</description></item></rss>"""
    got = payloads.feed_items(spark.createDataFrame([(feed, "f")], "t string, src string"), "t", "src").orderBy("pos").collect()
    assert [(r.titulo, r.url, r.fecha_publicacion) for r in got] == [("Choque en la avenida", "https://c.example/1", "lunes"), ("Sin enlace", "", "")]
    assert (got[0].relevance_score, got[0].sentiment, got[0].es_trafico) == (0.67, "negativo", True)
    import hashlib

    assert got[0].item_id == hashlib.md5(b"https://c.example/1").hexdigest()[:12]
    assert got[1].item_id == hashlib.md5(b"Sin enlace").hexdigest()[:12]


def test_keywords_match_inside_words_and_accents_count_twice(spark):
    df = spark.createDataFrame([("VIAJE",), ("Vía y via",), ("caos y apertura",), ("",)], "t string")
    got = [tuple(r) for r in df.select(tx.relevance("t"), tx.sentiment("t")).collect()]
    assert got == [(0.33, "neutro"), (0.67, "neutro"), (0.0, "neutro"), (0.0, "neutro")]


def test_sensor_xml_defaults(spark):
    xml = "<pms><pm><idelem>1</idelem><intensidad>x</intensidad><nivelServicio>2</nivelServicio><error>N</error></pm><pm><idelem>2</idelem></pm><pm><carga>3</carga></pm></pms>"
    got = rows(payloads.sensor_readings(spark.createDataFrame([(xml,)], "p string"), "p"), "sensor_id", "intensidad", "nivel", "error")
    assert got == [("1", 0, "2", "N"), ("2", 0, "-1", "S")]


def test_exact_mean_matches_fraction(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (0.3,)], "x double")
    assert df.agg(nm.exact_mean("x", 3).alias("m")).head().m == 0.2
    assert df.filter("x > 5").agg(nm.exact_mean("x", 3).alias("m")).head().m is None


def test_kpi_fallbacks(spark):
    df = spark.createDataFrame([(DAY, 8, 40.0, 0.5, "alto"), (DAY, 9, 50.0, 0.25, "bajo")], "fecha date, hora int, velocidad_kmh double, congestion_ratio double, nivel_congestion string")
    got = {r.KPI: r.Valor for r in kpi.global_kpis(df).collect()}
    assert got["Velocidad promedio (km/h)"] == "45.0" and got["Zona más congestionada"] == "N/D"
    assert got["Velocidad mínima zona crítica (km/h)"] == "45.0" and got["Registros con evento activo"] == "0"
    hours = kpi.hour_kpis(df.drop("hora", "nivel_congestion")).collect()
    assert [(r.hora, r.hora_label) for r in hours] == [(0, "00:00")]


def test_composition_norm_sums_to_hundred(spark):
    df = spark.createDataFrame([(50.0, 30.0), (40.0, 20.0)], "pct_bus double, pct_auto_taxi double")
    got = {r.tipo_vehiculo: (r.porcentaje, r.porcentaje_norm) for r in kpi.composition_kpis(df).collect()}
    assert got == {"Bus": (45.0, 64.29), "Auto/Taxi": (25.0, 35.71)}


def test_dominant_level_first_wins(spark):
    df = spark.createDataFrame([(40.0, 40.0, 20.0)], "pct_alto double, pct_medio double, pct_bajo double")
    assert df.select(kpi.dominant_level({"pct_alto": "alto", "pct_medio": "medio", "pct_bajo": "bajo"}).alias("d")).head().d == "alto"


def test_top_with_ties(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 2.0), ("d", 1.0), ("e", None)], "zona string, congestion_ratio double")
    assert {r.zona for r in measures.top_with_ties(df, "congestion_ratio", 2).collect()} == {"a", "b", "c"}
    assert {r.zona for r in measures.top_with_ties(df, "congestion_ratio", 9).collect()} == {"a", "b", "c", "d", "e"}
    assert measures.top_zones(df, 2).head().top_zonas == "a, b, c"
    tied = df.filter("zona in ('b', 'c')")
    assert measures.most_congested(tied).head().zona_mas_congestionada is None


def test_blank_measure_when_not_unique(spark):
    df = spark.createDataFrame([("k", "1"), ("k", "2"), ("j", "3")], "KPI string, Valor string")
    got = df.agg(measures.kpi_number("k").alias("k"), measures.kpi_number("j").alias("j")).head()
    assert (got.k, got.j) == (None, 3.0)


def test_speed_change_without_previous_hour(spark):
    df = spark.createDataFrame([(5, 30.0)], "hora int, velocidad_kmh double")
    assert measures.speed_change(df).head().variacion_velocidad == 0.0


def test_profile_priors_and_floors(spark):
    df = spark.createDataFrame([("a", 1, "alto", 1.0)] * 3 + [("b", 1, "alto", 1.0)], "zona string, hora int, nivel_congestion string, m double")
    got = {r.zona: r for r in pf.class_probabilities(df).collect()}
    assert got["b"].p_alto == pytest.approx(0.33) and got["a"].p_alto == pytest.approx(1.0 / 1.67)
    profile = pf.zone_hour_profile(df, ["m"]).collect()
    assert [(r.zona, r.n, r.std_m) for r in profile] == [("a", 3, 0.01)]


def test_weekday_factor_is_a_full_week(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 4.0)], "dia_semana int, congestion_ratio double")
    got = {r.dia_semana: r.factor for r in pf.weekday_factors(df).collect()}
    assert got == {0: 0.5, 1: 2.0, **{d: 1.0 for d in range(2, 7)}}


def test_adaptive_window_widens(spark):
    days = [datetime.date(2026, 6, 1) + datetime.timedelta(days=i) for i in range(28)]
    df = spark.createDataFrame([(d,) for d in days], "fecha date")
    as_of = F.lit(datetime.date(2026, 6, 28))
    assert pf.recent_or_wider(df, as_of, 7, enough=8).count() == 8
    assert pf.recent_or_wider(df, as_of, 7, enough=9).count() == 22


def test_null_report_and_defaults(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(ql.null_report(df, {"G": ["a", "b", "absent"]}), "columna", "nulos") == [("a", 1), ("b", 2)]
    filled = ql.with_defaults(df, {"a": 0, "c": "x"}).collect()
    assert [(r.a, r.c) for r in filled] == [(1, "x"), (0, "x")]


def test_quality_report_of_empty_source(spark):
    empty = spark.createDataFrame([], "k double, _calidad_fuente string")
    got = ql.quality_report({"s": (empty, empty, "k")}).head()
    assert (got.registros_bronze, got.pct_retenidos, got.calidad_fuente) == (0, 0.0, "?")


def test_feed_text_is_scored_beyond_the_stored_length(spark):
    from citylake.sources.payloads import feed_items

    item = "<title><![CDATA[ canal ]]></title><title><![CDATA[ nota ]]></title><description>x</description><description>{}</description>"
    feeds = spark.createDataFrame([("a", item.format("aquí " * 100 + "accidente")), ("b", item.format("aquí " * 100))], "k string, feed string")
    got = {r.k: r for r in feed_items(feeds.withColumn("o", F.lit("web")), "feed", "o", "k").collect()}
    assert got["a"].es_trafico and not got["b"].es_trafico and len(got["a"].descripcion) == 300


def test_learned_rates_are_bounded_only_where_asked(spark):
    events = spark.createDataFrame([(DAY, "obras")] * 12, "fecha date, tipo string")
    assert {r.prob_evento for r in pf.event_rate(events, 6).collect()} == {2.0}
    assert {r.prob_evento for r in pf.event_rate(events, 6, cap=0.3).collect()} == {0.3}
    news = spark.createDataFrame([(1, "neutro", True)] * 25, "_ingest_ts int, sentiment string, es_trafico boolean")
    assert [pf.news_rate(news).head().n_por_lote, pf.news_rate(news, low=2.0, high=10.0).head().n_por_lote] == [25.0, 10.0]
