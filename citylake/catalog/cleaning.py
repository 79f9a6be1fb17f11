"""Filters, dedup, defaults, windows of dates, set operations, sorts."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.catalog import oracle as o
from citylake.catalog.registry import query
from citylake.catalog.views import city_events, readings, table
from citylake.functions.numeric import lookup
from citylake.dims import SOURCE_QUALITY
from citylake.operators.profile import recent_or_wider
from citylake.operators.quality import apply_ranges, first_row, require, union_common, with_defaults
from citylake.operators.upsert import first_wins, newest_wins
from citylake.operators.measures import top_with_ties
from citylake.sources.agenda import agenda, with_sentinel
from citylake.sources.sinks import missing_days

R = o.ctes(o.READINGS)
AS_OF = "1998-01-01"


@query("null_filter", R + "SELECT event_id, temperatura_c, congestion_factor FROM r WHERE temperatura_c IS NOT NULL AND congestion_factor IS NOT NULL")
def _(spark, sf):
    rows = readings(spark, sf).select("event_id", "temperatura_c", "congestion_factor")
    return require(rows, ["temperatura_c", "congestion_factor"])


@query(
    "range_filter",
    R + "SELECT event_id, congestion_ratio, velocidad_kmh, congestion_factor FROM r WHERE congestion_ratio BETWEEN 0 AND 1 AND velocidad_kmh BETWEEN 1 AND 130 AND congestion_factor BETWEEN 1 AND 5 AND total_detectado >= 0",
)
def _(spark, sf):
    kept = apply_ranges(
        readings(spark, sf),
        {"congestion_ratio": (0, 1), "velocidad_kmh": (1, 130), "congestion_factor": (1.0, 5.0), "total_detectado": (0, None)},
    )
    return kept.select("event_id", "congestion_ratio", "velocidad_kmh", "congestion_factor")


@query(
    "dedup_first",
    R + "SELECT zona, strftime(ingest_ts, '%Y-%m-%d %H:%M') AS lote, min(event_id) AS event_id, arg_min(v, event_id) AS v FROM r GROUP BY zona, ingest_ts",
)
def _(spark, sf):
    r = readings(spark, sf).select("zona", "_ingest_ts", "event_id", "v")
    return first_row(r, ["zona", "_ingest_ts"], ["event_id"]).select(
        "zona", F.date_format("_ingest_ts", "yyyy-MM-dd HH:mm").alias("lote"), "event_id", "v"
    )


@query(
    "default_fill",
    R + "SELECT event_id, coalesce(congestion_factor, 1.0::DOUBLE) AS congestion_factor, coalesce(temperatura_c, 0.0::DOUBLE) AS temperatura_c, 'ninguno' AS tipo_evento, FALSE AS tiene_evento FROM r",
)
def _(spark, sf):
    r = readings(spark, sf).select("event_id", "congestion_factor", "temperatura_c")
    return with_defaults(
        r, {"congestion_factor": 1.0, "temperatura_c": 0.0, "tipo_evento": "ninguno", "tiene_evento": False}
    )


@query(
    "prefix_columns",
    o.ctes(o.READINGS, o.CAMERAS_RAW) + "SELECT event_id, cnt_auto_taxi, cnt_combi_minibus, cnt_moto_mototaxi, cnt_bus, cnt_camioneta_lgv, cnt_camion_hgv FROM cam0",
)
def _(spark, sf):
    from citylake.catalog.views import bronze_sources

    cameras = bronze_sources(spark, sf, ["vision_camaras"])["vision_camaras"]
    return cameras.select("event_id", *[c for c in cameras.columns if c.startswith("cnt_")])


@query("columns_by_type", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def _(spark, sf):
    from citylake.ml.select import split_columns

    lines = table(spark, sf, "lineitem")
    _, numeric = split_columns(lines, "l_returnflag")
    return lines.select(*numeric)


@query("drop_identifiers", "SELECT o_totalprice, o_orderstatus, o_orderpriority FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").drop("o_orderkey", "o_custkey", "o_orderdate", "absent_column")


@query(
    "date_window",
    f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha, CAST(CAST(o_orderdate AS DATE) - DATE '{AS_OF}' AS INTEGER) AS dias_para_evento
    FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + 7""",
)
def _(spark, sf):
    from citylake.sources.agenda import in_window

    as_of = F.lit(datetime.date.fromisoformat(AS_OF))
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").filter(in_window(day, as_of)).select(
        "o_orderkey", day.alias("fecha"), F.datediff(day, as_of).alias("dias_para_evento")
    )


_AGENDA_COLUMNS = "fecha, nombre, tipo, zona_afectada, severidad, impacto_factor, dias_para_evento, sub_fuente"


@query(
    "agenda_union",
    o.ctes(
        o.CITY_EVENTS,
        "h AS (SELECT fecha, nombre FROM ev0 WHERE tipo = 'feriado_oficial')",
        "c AS (SELECT * FROM ev0 WHERE tipo <> 'feriado_oficial')",
    )
    + """SELECT fecha, nombre, 'feriado_oficial' AS tipo, 'todas' AS zona_afectada, 'media' AS severidad, 1.2::DOUBLE AS impacto_factor,
      CAST(fecha - DATE '2024-01-10' AS INTEGER) AS dias_para_evento, 'feriados' AS sub_fuente FROM h WHERE fecha BETWEEN DATE '2024-01-10' AND DATE '2024-01-17'
    UNION ALL SELECT fecha, nombre, tipo, zona_afectada, severidad,
      CAST(CASE severidad WHEN 'alta' THEN 1.45 WHEN 'media' THEN 1.20 WHEN 'baja' THEN 1.08 ELSE 1.0 END AS DOUBLE),
      CAST(fecha - DATE '2024-01-10' AS INTEGER), 'calendario' FROM c WHERE fecha BETWEEN DATE '2024-01-10' AND DATE '2024-01-17'""",
)
def _(spark, sf):
    events = city_events(spark, sf)
    holidays = events.filter(F.col("tipo") == "feriado_oficial").select("fecha", "nombre")
    calendar = events.filter(F.col("tipo") != "feriado_oficial").select("fecha", "nombre", "tipo", "zona_afectada", "severidad")
    as_of = F.lit(datetime.date(2024, 1, 10))
    return agenda(holidays, calendar, as_of).select(*_AGENDA_COLUMNS.split(", "))


@query(
    "sentinel_row",
    """WITH w AS (SELECT CAST(o_orderdate AS DATE) AS fecha, 'orden ' || o_orderkey AS nombre FROM orders WHERE o_orderdate >= DATE '2030-01-01')
    SELECT * FROM w UNION ALL SELECT (SELECT CAST(max(o_orderdate) AS DATE) FROM orders), 'Sin eventos relevantes' WHERE NOT EXISTS (SELECT 1 FROM w)""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    future = orders.filter(F.col("o_orderdate") >= "2030-01-01").select(
        F.to_date("o_orderdate").alias("fecha"), F.concat(F.lit("orden "), F.col("o_orderkey").cast("string")).alias("nombre")
    )
    quiet = orders.agg(F.to_date(F.max("o_orderdate")).alias("fecha")).withColumn("nombre", F.lit("Sin eventos relevantes"))
    return with_sentinel(future, quiet)


@query(
    "adaptive_window",
    """WITH p AS (SELECT CAST(max(o_orderdate) AS DATE) + 4 AS as_of FROM orders),
    n AS (SELECT count(*) AS n FROM orders, p WHERE o_orderdate >= as_of - 7)
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha FROM orders, p, n WHERE o_orderdate >= as_of - CASE WHEN n < 50 THEN 21 ELSE 7 END""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("fecha"))
    as_of = orders.agg(F.date_add(F.max("fecha"), 4)).scalar()
    return recent_or_wider(orders, as_of, days=7, enough=50, widen=3)


@query(
    "lineage_columns",
    "SELECT event_id, 'gps_rutas' AS _fuente, 'real' AS _calidad_fuente, 'desconocido' AS calidad_otra FROM events",
)
def _(spark, sf):
    from citylake.sources.sinks import with_lineage

    e = table(spark, sf, "events").select("event_id", "ts")
    return with_lineage(e, "gps_rutas", F.col("ts")).select(
        "event_id", "_fuente", "_calidad_fuente", lookup(F.lit("otra"), SOURCE_QUALITY, "desconocido").alias("calidad_otra")
    )


@query("text_truncate", "SELECT doc_id, substr(text, 1, 200) AS titulo, substr(text, 1, 300) AS descripcion FROM documents WHERE trim(text) <> ''")
def _(spark, sf):
    """The cut is the feature: news titles and summaries have a length limit."""
    return table(spark, sf, "documents").filter(F.trim("text") != "").select(
        "doc_id", F.substring("text", 1, 200).alias("titulo"), F.substring("text", 1, 300).alias("descripcion")
    )


@query(
    "union_common",
    "SELECT c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier",
)
def _(spark, sf):
    c = table(spark, sf, "customer").withColumnsRenamed({"c_nationkey": "nationkey", "c_acctbal": "acctbal"})
    s = table(spark, sf, "supplier").withColumnsRenamed({"s_nationkey": "nationkey", "s_acctbal": "acctbal"})
    return union_common(c, s)


@query(
    "union_subsources",
    "SELECT 'cliente' AS origen, c_name AS nombre, c_acctbal AS acctbal, c_mktsegment AS segmento FROM customer UNION ALL SELECT 'proveedor', s_name, s_acctbal, NULL FROM supplier",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select(
        F.lit("cliente").alias("origen"), F.col("c_name").alias("nombre"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segmento")
    )
    s = table(spark, sf, "supplier").select(
        F.lit("proveedor").alias("origen"), F.col("s_name").alias("nombre"), F.col("s_acctbal").alias("acctbal")
    )
    return c.unionByName(s, allowMissingColumns=True)


@query("distinct_dates", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha, CAST(year(o_orderdate) AS INTEGER) AS anio FROM orders")
def _(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(day.alias("fecha"), F.year(day).alias("anio")).distinct()


@query("distinct_count", o.ctes(o.READINGS) + "SELECT count(DISTINCT fecha) AS dias, count(DISTINCT event_type) AS clases, count(DISTINCT zona) AS zonas FROM r")
def _(spark, sf):
    return readings(spark, sf).agg(
        F.countDistinct("fecha").alias("dias"), F.countDistinct("event_type").alias("clases"), F.countDistinct("zona").alias("zonas")
    )


@query(
    "topn_ties",
    "SELECT p_partkey, p_size FROM (SELECT p_partkey, p_size, rank() OVER (ORDER BY p_size DESC) AS rk FROM part) WHERE rk <= 3",
)
def _(spark, sf):
    return top_with_ties(table(spark, sf, "part").select("p_partkey", "p_size"), "p_size", 3)


@query(
    "mixed_sort_limit",
    "SELECT CAST(o_orderdate AS DATE) AS fecha, o_totalprice, o_orderkey FROM orders ORDER BY fecha ASC, o_totalprice DESC, o_orderkey LIMIT 100",
)
def _(spark, sf):
    """A preview: the limit is the feature."""
    rows = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("fecha"), "o_totalprice", "o_orderkey")
    return rows.orderBy(F.asc("fecha"), F.desc("o_totalprice"), "o_orderkey").limit(100)


@query(
    "upsert_priority",
    """WITH h AS (SELECT o_custkey AS k, max(o_totalprice) AS precio, min(o_orderstatus) AS estado FROM orders GROUP BY 1),
    n AS (SELECT c_custkey AS k, c_acctbal AS precio, c_mktsegment AS segmento FROM customer)
    SELECT coalesce(n.k, h.k) AS k, CASE WHEN n.k IS NOT NULL THEN n.precio ELSE h.precio END AS precio,
      CASE WHEN n.k IS NULL THEN h.estado END AS estado, n.segmento FROM h FULL JOIN n ON h.k = n.k""",
)
def _(spark, sf):
    history = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.max("o_totalprice").alias("precio"), F.min("o_orderstatus").alias("estado")
    )
    fresh = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("precio"), F.col("c_mktsegment").alias("segmento")
    )
    return newest_wins([history, fresh], ["k"])


@query(
    "upsert_common",
    """WITH h AS (SELECT o_custkey AS k, max(o_totalprice) AS precio FROM orders GROUP BY 1), n AS (SELECT c_custkey AS k, c_acctbal AS precio FROM customer)
    SELECT coalesce(n.k, h.k) AS k, CASE WHEN n.k IS NOT NULL THEN n.precio ELSE h.precio END AS precio FROM h FULL JOIN n ON h.k = n.k""",
)
def _(spark, sf):
    history = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.max("o_totalprice").alias("precio"), F.min("o_orderstatus").alias("estado")
    )
    fresh = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("precio"), F.col("c_mktsegment").alias("segmento")
    )
    return newest_wins([history, fresh], ["k"], common=True)


@query(
    "dedup_history",
    """WITH a AS (SELECT l_partkey AS k, min(l_suppkey) AS v FROM lineitem GROUP BY 1), b AS (SELECT p_partkey AS k, CAST(p_size AS BIGINT) AS v FROM part)
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.v, b.v) AS v FROM a FULL JOIN b ON a.k = b.k""",
)
def _(spark, sf):
    a = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("k")).agg(F.min("l_suppkey").alias("v"))
    b = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").cast("bigint").alias("v"))
    return first_wins([a, b], ["k"])


@query(
    "anti_join_days",
    o.ctes(o.READINGS, "w AS (SELECT DISTINCT fecha FROM r WHERE event_type = 'purchase' AND k < 2)")
    + "SELECT event_id, fecha FROM r WHERE fecha NOT IN (SELECT fecha FROM w)",
)
def _(spark, sf):
    r = readings(spark, sf).select("event_id", "fecha", "event_type", "k")
    written = r.filter((F.col("event_type") == "purchase") & (F.col("k") < 2))
    return missing_days(r, written, "fecha").select("event_id", "fecha")


@query("row_sample", "SELECT TRUE AS son_filas, TRUE AS sin_repetir, TRUE AS proporcion")
def _(spark, sf):
    """Bernoulli sample: its rows are rows of the table, none twice, about 5 % of them."""
    lines = table(spark, sf, "lineitem")
    sampled = lines.sample(False, 0.05, 700)
    key = ["l_orderkey", "l_linenumber"]
    whole = lines.groupBy(*key).agg(F.count(F.lit(1)).alias("n_all"), F.bit_xor(F.xxhash64(*lines.columns)).alias("h_all"))
    part = sampled.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*lines.columns)).alias("h"))
    both = whole.join(part, key, "left")
    share = F.sum(F.coalesce("n", F.lit(0))) / F.sum("n_all")
    return both.agg(
        F.bool_and(F.col("n").isNull() | (F.col("n") < F.col("n_all")) | (F.col("h") == F.col("h_all"))).alias("son_filas"),
        F.bool_and(F.coalesce(F.col("n") <= F.col("n_all"), F.lit(True))).alias("sin_repetir"),
        share.between(0.04, 0.06).alias("proporcion"),
    )


@query(
    "nan_as_null",
    R + "SELECT zona, count(x) AS n, round_even(avg(x), 3) AS media, max(x) AS maximo FROM (SELECT zona, CASE WHEN k % 5 <> 0 THEN v END AS x FROM r) GROUP BY zona",
)
def _(spark, sf):
    from citylake.functions.numeric import nan_to_null, np_round

    nan = F.lit(float("nan")).cast(T.DoubleType())
    r = readings(spark, sf).select("zona", F.when(F.col("k") % 5 != 0, F.col("v")).otherwise(nan).alias("x"))
    return nan_to_null(r).groupBy("zona").agg(
        F.count("x").alias("n"), np_round(F.avg("x"), 3).alias("media"), F.max("x").alias("maximo")
    )
