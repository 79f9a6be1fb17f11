"""Raw payload text to typed rows: sensor XML, trip / weather / holiday JSON, feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions.numeric import lenient_int
from citylake.functions.text import add_scores, item_id, strip_tags
from citylake.functions.traffic import trip_factor, trip_speed

# ---- fixed values: payload fields and feed patterns ---------------------------

SENSOR_XML = """pm array<struct<idelem:string, intensidad:string, ocupacion:string, carga:string,
    intensidadSat:string, nivelServicio:string, error:string>>"""

TRIP_JSON = """status string, rows array<struct<elements:array<struct<status:string,
    distance:struct<value:bigint>, duration:struct<value:bigint>,
    duration_in_traffic:struct<value:bigint>>>>>"""

WEATHER_JSON = """current struct<time:string, temperature_2m:double, relative_humidity_2m:double,
    precipitation:double, wind_speed_10m:double, weather_code:int>"""

HOLIDAY_JSON = "array<struct<date:string, localName:string>>"

FEED_TITLE = r"(?s)<title[^>]*>(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?</title>"
FEED_DESCRIPTION = r"(?s)<description[^>]*>(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?</description>"
FEED_LINK = r"<link[^>]*>(?:<!\[CDATA\[)?\s*(https?://[^\s<]+)\s*(?:\]\]>)?</link>"
FEED_DATE = r"<(?:pubDate|published|updated)>(.*?)</(?:pubDate|published|updated)>"

# ---- end of fixed values ------------------------------------------------------


def sensor_readings(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    """One row per detector element; unreadable numbers become 0, absent level -1, absent error S."""
    parsed = df.select(*keep, F.explode(F.from_xml(F.col(payload), SENSOR_XML)["pm"]).alias("pm"))

    def number(field: str):
        return F.coalesce(lenient_int(F.col("pm")[field]), F.lit(0))

    return parsed.select(
        *keep,
        F.col("pm.idelem").alias("sensor_id"),
        number("intensidad").alias("intensidad"),
        number("ocupacion").alias("ocupacion"),
        number("carga").alias("carga"),
        number("intensidadSat").alias("saturacion"),
        F.coalesce("pm.nivelServicio", F.lit("-1")).alias("nivel"),
        F.coalesce("pm.error", F.lit("S")).alias("error"),
    ).filter(F.col("sensor_id").isNotNull() & (F.col("sensor_id") != ""))


def trips(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    """First element of each distance answer; both status levels must be OK."""
    answer = F.from_json(F.col(payload), TRIP_JSON)
    first = df.select(*keep, answer.alias("a")).filter(F.col("a.status") == "OK").select(
        *keep, F.get(F.get(F.col("a.rows"), 0)["elements"], 0).alias("e")
    )
    ok = first.filter(F.col("e.status") == "OK")
    metres, free, taken = F.col("e.distance.value"), F.col("e.duration.value"), F.col("e.duration_in_traffic.value")
    return ok.select(
        *keep,
        metres.alias("distancia_m"),
        free.alias("duracion_libre_s"),
        F.coalesce(taken, free).alias("duracion_trafico_s"),
        trip_factor(free, taken).alias("congestion_factor"),
        trip_speed(metres, free, taken).alias("velocidad_kmh"),
    )


def weather_readings(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    current = df.select(*keep, F.from_json(F.col(payload), WEATHER_JSON)["current"].alias("c"))
    return current.select(
        *keep,
        F.col("c.time").alias("hora_local"),
        F.col("c.temperature_2m").alias("temperatura_c"),
        F.col("c.relative_humidity_2m").alias("humedad_pct"),
        F.col("c.precipitation").alias("precipitacion_mm"),
        F.col("c.wind_speed_10m").alias("viento_kmh"),
        F.col("c.weather_code").alias("codigo_clima"),
    ).filter(F.col("temperatura_c").between(-5, 45) & F.col("humedad_pct").between(0, 100))


def holidays(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.inline(F.from_json(F.col(payload), HOLIDAY_JSON))).select(
        *keep, F.col("date").try_cast("date").alias("fecha"), F.col("localName").alias("nombre")
    )


def feed_items(df: DataFrame, text: str, source: str, *keep: str) -> DataFrame:
    """News items of a feed document, scored over their whole text; the description is
    shortened only for storage.

    Fields are aligned by position; the channel's own title comes first and is
    skipped, and the channel carries no date, so dates sit one place earlier.
    """

    def every(pattern: str):
        return F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))

    no_date = F.array(F.lit(None).cast("string"))
    zipped = F.arrays_zip(
        every(FEED_TITLE).alias("t"),
        every(FEED_DESCRIPTION).alias("d"),
        every(FEED_LINK).alias("l"),
        F.concat(no_date, every(FEED_DATE)).alias("f"),
    )
    rows = df.select(*keep, F.col(source).alias("fuente"), F.posexplode(zipped).alias("pos", "x"))
    items = rows.filter("pos >= 1").select(
        *keep,
        "fuente",
        "pos",
        strip_tags(F.col("x.t")).alias("_title"),
        strip_tags(F.coalesce(F.col("x.d"), F.lit(""))).alias("_description"),
        F.coalesce(F.col("x.l"), F.lit("")).alias("url"),
        F.substring(F.coalesce(F.col("x.f"), F.lit("")), 1, 50).alias("fecha_publicacion"),
    ).filter(F.col("_title") != "")
    scored = add_scores(items.withColumn("_text", F.concat_ws(" ", "_title", "_description")), "_text")
    return scored.select(
        *keep,
        "fuente",
        "pos",
        item_id(F.col("url"), F.col("_title")).alias("item_id"),
        F.substring("_title", 1, 200).alias("titulo"),
        F.substring("_description", 1, 300).alias("descripcion"),
        "url",
        "fecha_publicacion",
        "relevance_score",
        "sentiment",
        "es_trafico",
    )
