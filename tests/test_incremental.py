"""Tables kept per day, and streams that chain, join and part late rows: what is read, what stays."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from citylake.catalog.products import cleaned, gold
from citylake.operators import kpi
from citylake.operators.profile import day_moments, merged_moments, zone_hour_profile
from citylake.plans import jobs
from citylake.session import shared_dir
from citylake.streaming import gold as sg
from citylake.streaming import jobs as st


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_gold(spark, sf_dir):
    path = f"{shared_dir(spark, 'test-gold')}/congestion_por_zona"
    gold(spark, sf_dir).write.partitionBy("fecha").parquet(path)
    return path


def rows(df):
    return sorted(map(str, df.collect()))


def test_partials_give_the_tables_of_the_whole(spark, stored_gold):
    whole = spark.read.parquet(stored_gold)
    parts = jobs.kpi_tables_of(kpi.day_partials(whole))
    for name, table in jobs.kpi_tables(whole).items():
        assert rows(parts[name].select(*table.columns)) == rows(table), name


def test_refresh_of_sums_reads_stale_days_only(spark, stored_gold):
    sums = shared_dir(spark, "test-sums")
    days = [datetime.date(2024, 1, d) for d in (10, 11)]
    assert len(jobs.stale_days(spark, stored_gold, sums, days)) > 25
    jobs.refresh_kpi_partials(spark, stored_gold, sums, [])
    assert jobs.stale_days(spark, stored_gold, sums, days) == days
    once = rows(spark.read.parquet(sums))
    jobs.refresh_kpi_partials(spark, stored_gold, sums, days)
    assert rows(spark.read.parquet(sums)) == once
    text = plan(kpi.day_partials(spark.read.parquet(stored_gold).filter(F.col("fecha").isin(days))))
    assert text.count("FileScan") == 1 and re.search(r"PartitionFilters: \[[^\]]*fecha", text)
    export = plan(jobs.kpi_tables_of(spark.read.parquet(sums))["kpi_resumen"])
    assert "test-sums" in export and "congestion_por_zona" not in export


def test_zones_that_appear_or_fall_silent_keep_their_newest_hour(spark):
    columns = "zona string, fecha date, hora int, velocidad_kmh double, congestion_ratio double, intensidad_veh_hora double, total_vehiculos_zona double, nivel_congestion string, tiene_evento int"
    day = datetime.date(2024, 1, 1)
    data = [("a", day, 3, 10.0, 0.5, None, 1.0, "alto", 1), ("a", day, 9, 30.0, None, 5.0, None, None, 0)]
    data += [("b", day + datetime.timedelta(days=2), 0, 20.0, 0.9, 7.0, 2.0, "bajo", None)]
    frame = spark.createDataFrame(data, columns).withColumn("pct_bus", F.lit(12.5))
    parts = jobs.kpi_tables_of(kpi.day_partials(frame))
    for name, whole in jobs.kpi_tables(frame).items():
        assert rows(parts[name].select(*whole.columns)) == rows(whole), name
    values = {r["KPI"]: r["Valor"] for r in parts["kpi_resumen"].collect()}
    assert values["Zona más congestionada"] == "b" and values["Velocidad mínima zona crítica (km/h)"] == "20.0"


def test_moments_of_days_merge_to_the_moments_of_all(spark, sf_dir):
    from citylake.catalog.views import readings

    several = readings(spark, sf_dir).withColumn("nivel_congestion", F.lit("alto")).withColumn("velocidad_kmh", F.col("velocidad_kmh") + 1e6)
    metrics = ["velocidad_kmh", "congestion_ratio"]
    first, last = datetime.date(2024, 1, 1), datetime.date(2024, 1, 30)
    merged = merged_moments(day_moments(several, metrics), first, last, metrics)
    assert plan(merged).count("Exchange hashpartitioning") == 2  # per day, and per window
    want = {(r["zona"], r["hora"]): r for r in zone_hour_profile(several, metrics, at_least=1).collect()}
    for r in merged.collect():
        other = want[r["zona"], r["hora"]]
        assert r["n"] == other["n"]
        for m in metrics:
            assert r[f"mean_{m}"] == other[f"mean_{m}"] or r[f"c_{m}"] == 0
            if r[f"c_{m}"] > 1:
                assert max(r[f"std_{m}"], 0.01) == pytest.approx(other[f"std_{m}"], rel=1e-6)


def test_one_scan_of_gold_for_all_windows(spark, stored_gold):
    path = shared_dir(spark, "test-moments")
    jobs.refresh_moments(spark.read.parquet(stored_gold), path)
    moments = spark.read.parquet(path)
    for day in (14, 21, 30):
        for table in jobs.sliding_profiles(moments, datetime.date(2024, 1, day)).values():
            assert "congestion_por_zona" not in plan(table)
    assert jobs.sliding_profiles(moments, datetime.date(2023, 1, 1))["prob_nivel"].count() == 6 * 24


def test_stream_needs_weather(spark):
    with pytest.raises(ValueError, match="weather"):
        sg.gold_stream({}, 99.0)


def test_late_rows_replayed_and_empty(spark):
    out, landed = shared_dir(spark, "test-late"), shared_dir(spark, "test-late-in")
    schema = "event_id long, _ingest_ts timestamp"
    at = datetime.datetime(2024, 1, 10)
    hour = datetime.timedelta(hours=1)
    batches = [[(1, at), (2, None)], [(3, at - 2 * hour), (4, at + hour), (5, at - hour)], [(6, at), (7, at + hour)]]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landed)
    for _ in range(2):  # the second run starts anew and overwrites every epoch
        stream = st.landed_stream(spark, landed, schema, files_per_batch=1)
        sg.split_late(stream, out, st.checkpoint_path(spark, "test-late"), hour, once=True).awaitTermination()
        late = {r["event_id"] for r in sg.late_rows(spark, out, schema).collect()}
        taken = {r["event_id"] for r in spark.read.schema(schema).parquet(f"{out}/taken").collect()}
        assert late == {3} and taken == {1, 2, 4, 5, 6, 7}
    assert {r["event_id"] for r in sg.with_late(spark, out, schema).collect()} == {3, 5}
    assert sg.late_rows(spark, shared_dir(spark, "never"), schema).collect() == []


def test_stream_of_one_source_leaves_the_rest_null(spark, sf_dir):
    weather = cleaned(spark, sf_dir, "clima")["clima"]
    landed, out = shared_dir(spark, "test-weather"), shared_dir(spark, "test-weather-out")
    weather.coalesce(1).write.parquet(landed)
    stream = sg.gold_stream({"clima": st.landed_stream(spark, landed, weather.schema)}, 99.0, lateness="1 hour")
    sg.append_days(stream, out, st.checkpoint_path(spark, "test-weather"), once=True).awaitTermination()
    table = spark.read.parquet(out)
    newest = weather.agg(F.max("_ingest_ts")).first()[0]
    closed = weather.filter(F.date_trunc("hour", "_ingest_ts") + F.expr("INTERVAL 1 HOUR") <= F.lit(newest - datetime.timedelta(hours=1)))
    assert table.count() == closed.select("zona", F.date_trunc("hour", "_ingest_ts")).distinct().count()
    assert table.filter("velocidad_kmh IS NOT NULL OR congestion_ratio IS NOT NULL OR tiene_evento = 1").isEmpty()


def test_lag_state_is_one_small_partition(spark, sf_dir):
    """The second run reads no older gold day; without the state it finds the same rows in gold."""
    from citylake.catalog.io_queries import _landed_sources
    from citylake.catalog.views import SOURCE_ORDER
    from citylake.session import remove_dir

    bronze = _landed_sources(spark, sf_dir)

    def run(root, days):
        for day, hours in days:
            out = jobs.refresh_gold(
                spark, bronze, root, ["clima", "gps_rutas"], datetime.datetime(2024, 1, day, 23), 99.0, hours,
                order=SOURCE_ORDER, storage=False, extra="event_id long, doc_id long",
            )
        return out

    root = shared_dir(spark, "test-lag")
    run(root, [(10, 24 * 9)])
    target, state, first = f"{root}/congestion_por_zona", f"{root}/ultimas_filas", datetime.date(2024, 1, 11)
    fresh = spark.read.parquet(target)
    kept = jobs.rows_before(spark, target, state, fresh, first)
    assert kept.inputFiles() and all("ultimas_filas" in f for f in kept.inputFiles())
    assert re.search(r"PartitionFilters: \[[^\]]*fecha", plan(kept)) and "congestion_por_zona" not in plan(kept)
    walked = jobs.rows_before(spark, target, shared_dir(spark, "no-state"), fresh, first)
    assert rows(kept) == rows(walked) and kept.count() == 6
    whole = rows(run(root, [(12, 24), (12, 48)]).select(*sorted(fresh.columns)))
    other = shared_dir(spark, "test-lag-other")
    assert rows(run(other, [(12, 24 * 11)]).select(*sorted(fresh.columns))) == whole
    remove_dir(spark, f"{root}/ultimas_filas/fecha=2024-01-10")  # as a run cut short leaves it
    assert rows(run(root, [(12, 24)]).select(*sorted(fresh.columns))) == whole


def test_stored_report_reads_no_data_columns_for_counts(spark, sf_dir):
    from citylake.operators.quality import stored_report

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan(stored_report({"orders": (orders, orders, "o_custkey", "real")}))
    assert sorted(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == ["", "o_custkey:bigint"]


def test_order_in_files_sees_a_row_out_of_place(spark):
    from citylake.sources.sinks import order_in_files, overwrite_days

    path = shared_dir(spark, "test-order")
    spark.createDataFrame([(k, "x") for k in (1, 2, 2, 5, 4, 6)], "k int, z string").coalesce(1).write.parquet(path)
    assert [tuple(r)[1:] for r in order_in_files(spark.read.parquet(path), ["k"]).collect()] == [(6, 1)]
    day = F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string"))
    many = spark.range(500).select(day.alias("fecha"), (-F.col("id")).alias("hora"))
    overwrite_days(many, shared := shared_dir(spark, "test-order"), "fecha", ["hora"], most_rows=40)
    files = order_in_files(spark.read.parquet(shared), ["hora"]).collect()
    assert sum(r["rows"] for r in files) == 500 and all(r["rows"] <= 40 and r["disordered"] == 0 for r in files)


def test_hadoop_uris_as_arrow_reads_them():
    from citylake.sources.files import arrow_uri, opened

    cases = {
        "s3a://bucket/a/b.bin": "s3://bucket/a/b.bin", "s3n://b/c": "s3://b/c", "s3://b/c": "s3://b/c", "gs://b/c": "gs://b/c",
        "hdfs://host:8020/x": "hdfs://host:8020/x", "viewfs://store/x": "hdfs://store/x", "dbfs:/mnt/x": "file:///dbfs/mnt/x",
        "file:/tmp/x": "file:///tmp/x", "file:///tmp/x": "file:///tmp/x", "/tmp/x": "/tmp/x",
    }
    assert {uri: arrow_uri(uri) for uri in cases} == cases
    for uri in ("file:/tmp/x%20y", "/tmp/x y", "dbfs:/tmp"):
        assert opened(uri)[1] in ("/tmp/x y", "/dbfs/tmp")


def test_drifted_files_are_read_by_schema(spark):
    """Integer, double and text in one column, a late column, and a file that Arrow wrote."""
    import pyarrow as pa
    from pyarrow import parquet

    from citylake.sources.files import schema_groups
    from citylake.sources.readers import read_drifted
    from pyspark.sql import types as T

    path = shared_dir(spark, "test-drift")
    schema = T.StructType.fromDDL("event_id long, v double, extra string, _ingest_ts string")
    stamp = F.lit("2024-01-01T00:00:00").alias("_ingest_ts")
    for k, column in enumerate([F.col("id").cast("int"), F.col("id").cast("double"), F.concat("id", F.lit(".5")), F.lit("none")]):
        rows = spark.range(k * 10, k * 10 + 10).select(F.col("id").alias("event_id"), column.alias("v"), stamp)
        rows = rows.withColumn("extra", F.lit("x")) if k == 2 else rows
        rows.write.parquet(f"{path}/day={k}")
        rows.write.parquet(f"{path}/again/day={k}")
    name = path.removeprefix("file:")
    parquet.write_table(pa.table({"event_id": [99], "v": pa.array([7], pa.int32())}), f"{name}/plain.parquet")
    groups = schema_groups(spark, path)
    assert len(groups) == 5 and sum(len(files) for _, files in groups) > 8
    got = {(r["event_id"], r["v"], r["extra"]) for r in read_drifted(spark, path, schema).collect()}
    want = {(k, float(k), None) for k in range(20)} | {(k, k + 0.5, "x") for k in range(20, 30)} | {(k, None, None) for k in range(30, 40)}
    assert got == want | {(99, 7.0, None)}
    assert read_drifted(spark, shared_dir(spark, "never"), schema).collect() == []
