"""XML, JSON and feed payloads; text scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from citylake.catalog import oracle as o
from citylake.catalog.registry import query
from citylake.catalog.views import readings, table
from citylake.dims import NEGATIVE_WORDS, POSITIVE_WORDS, TRAFFIC_WORDS
from citylake.functions.text import item_id, relevance, sentiment, strip_tags, word_hits
from citylake.sources import payloads as pl

R = o.ctes(o.READINGS)


def s(c: str):
    return F.col(c).cast("string")


@query(
    "xml_payload",
    R
    + """SELECT event_id, 'A' || k AS sensor_id, CAST(floor(v) AS INTEGER) AS intensidad, CAST(k AS INTEGER) AS ocupacion, CAST(0 AS INTEGER) AS carga,
      CAST(k * 20 AS INTEGER) AS saturacion, CAST(k % 4 AS VARCHAR) AS nivel, 'N' AS error FROM r
    UNION ALL SELECT event_id, 'B' || user_id, CAST(0 AS INTEGER), CAST(0 AS INTEGER), CAST(user_id AS INTEGER), CAST(0 AS INTEGER), '-1', 'S' FROM r""",
)
def _(spark, sf):
    """Two detectors per payload; the second one lacks most fields."""
    xml = F.concat(
        F.lit("<pms><pm><idelem>A"), s("k"), F.lit("</idelem><intensidad>"), F.floor("v").cast("string"),
        F.lit("</intensidad><ocupacion>"), s("k"), F.lit("</ocupacion><carga>n/d</carga><intensidadSat>"), (F.col("k") * 20).cast("string"),
        F.lit("</intensidadSat><nivelServicio>"), (F.col("k") % 4).cast("string"),
        F.lit("</nivelServicio><error>N</error></pm><pm><idelem>B"), s("user_id"),
        F.lit("</idelem><carga>"), s("user_id"), F.lit("</carga></pm></pms>"),
    )
    raw = readings(spark, sf).select("event_id", xml.alias("payload"))
    return pl.sensor_readings(raw, "payload", "event_id")


@query(
    "json_trips",
    R
    + """, x AS (SELECT event_id, user_id * 100 AS m, k * 10 AS f, CASE WHEN k % 3 <> 0 THEN CAST(duracion_trafico_s AS BIGINT) END AS t FROM r WHERE k % 10 <> 1 AND k % 10 <> 2)
    SELECT event_id, CAST(m AS BIGINT) AS distancia_m, CAST(f AS BIGINT) AS duracion_libre_s, CAST(coalesce(t, f) AS BIGINT) AS duracion_trafico_s,
      CASE WHEN f > 0 THEN round_even(coalesce(t, f) / f, 3) ELSE 1.0::DOUBLE END AS congestion_factor,
      CASE WHEN coalesce(t, f) > 0 THEN round_even(m / coalesce(t, f) * 3.6::DOUBLE, 1) ELSE 0.0::DOUBLE END AS velocidad_kmh FROM x""",
)
def _(spark, sf):
    """Answers with an outer error, an inner error, or no traffic field."""
    k = F.col("k")
    traffic = F.when(k % 3 != 0, F.struct(F.col("duracion_trafico_s").cast("bigint").alias("value")))
    element = F.struct(
        F.when(k % 10 == 2, "ZERO_RESULTS").otherwise("OK").alias("status"),
        F.struct((F.col("user_id") * 100).alias("value")).alias("distance"),
        F.struct((k * 10).alias("value")).alias("duration"),
        traffic.alias("duration_in_traffic"),
    )
    answer = F.struct(
        F.when(k % 10 == 1, "REQUEST_DENIED").otherwise("OK").alias("status"),
        F.array(F.struct(F.array(element).alias("elements"))).alias("rows"),
    )
    raw = readings(spark, sf).select("event_id", F.to_json(answer).alias("payload"))
    return pl.trips(raw, "payload", "event_id")


@query(
    "json_weather",
    R
    + """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M') AS hora_local, v / 16 + 15 AS temperatura_c, humedad_pct, precipitacion_mm, viento_kmh, codigo_clima
    FROM r WHERE v / 16 + 15 BETWEEN -5 AND 45 AND humedad_pct BETWEEN 0 AND 100""",
)
def _(spark, sf):
    now = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        (F.col("v") / 16 + 15).alias("temperature_2m"),
        F.col("humedad_pct").alias("relative_humidity_2m"),
        F.col("precipitacion_mm").alias("precipitation"),
        F.col("viento_kmh").alias("wind_speed_10m"),
        F.col("codigo_clima").alias("weather_code"),
    )
    raw = readings(spark, sf).select("event_id", F.to_json(F.struct(now.alias("current"))).alias("payload"))
    return pl.weather_readings(raw, "payload", "event_id")


@query(
    "json_holidays",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha, 'Feriado ' || o_orderpriority AS nombre FROM orders
    UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE) + 1, 'Puente' FROM orders""",
)
def _(spark, sf):
    day = F.to_date("o_orderdate")
    listed = F.array(
        F.struct(day.cast("string").alias("date"), F.concat(F.lit("Feriado "), F.col("o_orderpriority")).alias("localName")),
        F.struct(F.date_add(day, 1).cast("string").alias("date"), F.lit("Puente").alias("localName")),
    )
    raw = table(spark, sf, "orders").select("o_orderkey", F.to_json(listed).alias("payload"))
    return pl.holidays(raw, "payload", "o_orderkey")


@query("json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def _(spark, sf):
    parsed = F.from_json("props", "k int")
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


# ---- feeds: page anchors rewritten as feed items ----------------------------------

_ANCHOR = r'<a href="([^"]*)">([^<]*)</a>'
_ITEM = (
    "<item><title><![CDATA[ {0}2 ]]></title><description>Ver <b>{0}2</b> " + "aquí " * 70 + "por accidente en la vía</description>"
    "<link>http://feed.example{0}1</link><pubDate>{0}1</pubDate></item>"
)


def feeds(spark, sf):
    items = F.regexp_replace("html", _ANCHOR, _ITEM.format("$"))
    text = F.concat(F.lit("<description>"), F.col("url"), F.lit("</description><link>"), F.col("url"), F.lit("</link>"), items)
    return table(spark, sf, "pages").select("page_id", F.lit("web").alias("origen"), text.alias("feed"))


def _rx(pattern: str) -> str:
    return f"regexp_extract_all(feed, {o.q(pattern)}, 1)"


_TEXT = "t || ' ' || d"
RSS_SQL = o.ctes(
    f"f AS (SELECT page_id, '<description>' || url || '</description><link>' || url || '</link>' || regexp_replace(html, {o.q(_ANCHOR)}, {o.q(_ITEM.format(chr(92)))}, 'g') AS feed FROM pages)",
    f"a AS (SELECT page_id, {_rx(pl.FEED_TITLE)} AS ts, {_rx(pl.FEED_DESCRIPTION)} AS ds, {_rx(pl.FEED_LINK)} AS ls, {_rx(pl.FEED_DATE)} AS fs FROM f)",
    "i AS (SELECT page_id, CAST(unnest(range(1, len(ts))) AS INTEGER) AS pos, ts, ds, ls, fs FROM a)",
    r"""x AS (SELECT page_id, pos, regexp_replace(regexp_replace(ts[pos + 1], '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g') AS t,
    regexp_replace(regexp_replace(coalesce(ds[pos + 1], ''), '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g') AS d,
    coalesce(ls[pos + 1], '') AS l, substr(coalesce(fs[pos], ''), 1, 50) AS f FROM i)""",
) + f"""SELECT page_id, 'web' AS fuente, pos, substr(md5(CASE WHEN l <> '' THEN l ELSE t END), 1, 12) AS item_id, substr(t, 1, 200) AS titulo, substr(d, 1, 300) AS descripcion, l AS url, f AS fecha_publicacion,
    {o.relevance_sql(_TEXT)} AS relevance_score, {o.sentiment_sql(_TEXT)} AS sentiment, {o.relevance_sql(_TEXT)} > 0 AS es_trafico FROM x WHERE t <> ''"""


@query("rss_items", RSS_SQL)
def _(spark, sf):
    return pl.feed_items(feeds(spark, sf), "feed", "origen", "page_id")


@query(
    "strip_tags",
    r"SELECT page_id, md5(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g')) AS huella, length(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g')) AS largo FROM pages",
)
def _(spark, sf):
    bare = strip_tags(F.col("html"))
    return table(spark, sf, "pages").select(
        "page_id", F.md5(bare.cast("binary")).alias("huella"), F.length(bare).cast("bigint").alias("largo")
    )


@query("item_id", "SELECT page_id, substr(md5(CASE WHEN page_id % 3 <> 0 THEN url ELSE html END), 1, 12) AS item_id FROM pages")
def _(spark, sf):
    link = F.when(F.col("page_id") % 3 != 0, F.col("url")).otherwise("")
    return table(spark, sf, "pages").select("page_id", item_id(link, F.col("html")).alias("item_id"))


@query(
    "keyword_relevance",
    f"SELECT doc_id, {o.hits('text', TRAFFIC_WORDS)} AS aciertos, {o.relevance_sql('text')} AS relevance_score, {o.relevance_sql('text')} > 0 AS es_trafico FROM documents",
)
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        word_hits("text", TRAFFIC_WORDS).alias("aciertos"),
        relevance("text").alias("relevance_score"),
        (relevance("text") > 0).alias("es_trafico"),
    )


@query(
    "keyword_sentiment",
    f"SELECT conv_id, turn, {o.hits('text', NEGATIVE_WORDS)} AS negativos, {o.hits('text', POSITIVE_WORDS)} AS positivos, {o.sentiment_sql('text')} AS sentiment FROM conversations",
)
def _(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        word_hits("text", NEGATIVE_WORDS).alias("negativos"),
        word_hits("text", POSITIVE_WORDS).alias("positivos"),
        sentiment("text").alias("sentiment"),
    )


@query("days_between", "SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER) AS dias FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return lines.join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", F.datediff("l_shipdate", "o_orderdate").alias("dias")
    )
