"""Writers that can be repeated, folder layouts, and stream behaviour against batch."""

import datetime

import pytest
from pyspark.sql import functions as F

from citylake.functions.numeric import np_round
from citylake.operators.upsert import replace_days, upsert_days
from citylake.schemas import bronze_schema
from citylake.session import shared_dir
from citylake.sources import readers as rd
from citylake.sources import sinks as sk
from citylake.streaming import jobs as st

DAY = datetime.date(2026, 6, 28)


def stamp(day, hour, minute=0):
    return datetime.datetime(2026, 6, day, hour, minute)


def readings(spark, data):
    return spark.createDataFrame(data, "zona string, _ingest_ts timestamp, v double")


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_bronze_append_adds_lineage_and_empty_batch_adds_no_file(spark):
    path = shared_dir(spark, "t-bronze")
    ts = F.to_timestamp(F.lit("2026-06-28 10:20:00"))
    sk.append_bronze(spark.createDataFrame([("a", 1.0)], "zona string, v double"), "clima", path, ts)
    sk.append_bronze(spark.createDataFrame([], "zona string, v double"), "clima", path, ts)
    got = spark.read.parquet(path)
    assert values(got, "zona", "_fuente", "_calidad_fuente", "ingest_date", "ingest_hour") == [("a", "clima", "real", DAY, 10)]
    assert len(got.inputFiles()) == 1


def test_folder_names_do_not_replace_event_dates(spark):
    path = shared_dir(spark, "t-layout")
    rows = spark.createDataFrame([("2026-07-04", "e", 1.2, "2026-06-28T10:00:00+00:00")], "fecha string, nombre string, impacto_factor double, _ingest_ts string")
    rows.write.parquet(f"{path}/fecha=2026-06-28/hora=10")
    got = rd.read_bronze(spark, [path], bronze_schema("eventos")).head()
    assert (got.fecha, got._ingest_ts) == ("2026-07-04", datetime.datetime(2026, 6, 28, 10))


def test_missing_table_is_empty_but_other_errors_surface(spark):
    schema = bronze_schema("clima")
    assert rd.read_or_empty(spark, shared_dir(spark, "t-none"), schema).count() == 0
    assert rd.read_bronze(spark, [shared_dir(spark, "t-none")], schema).columns == schema.names


def test_lookback_prunes_partitions(spark):
    path = shared_dir(spark, "t-look")
    sk.append_bronze(readings(spark, [("a", stamp(d, 12), float(d)) for d in range(1, 29)]), "clima", path, F.col("_ingest_ts"), by=("ingest_date",))
    recent = rd.recent_hours(spark.read.parquet(path), datetime.datetime(2026, 6, 28, 6), 24)
    assert values(recent, "v") == [(27.0,), (28.0,)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_backfill_keeps_written_days(spark):
    path = shared_dir(spark, "t-fill")
    first = spark.createDataFrame([(DAY, 1)], "ingest_date date, v int")
    second = spark.createDataFrame([(DAY, 2), (DAY + datetime.timedelta(days=1), 3)], "ingest_date date, v int")
    sk.backfill_days(first, path)
    sk.backfill_days(second, path)
    sk.backfill_days(second, path)
    assert values(spark.read.parquet(path), "v") == [(1,), (3,)]


def test_upsert_is_idempotent_and_leaves_other_days_alone(spark):
    path = shared_dir(spark, "t-gold")
    rows = lambda data: spark.createDataFrame(data, "zona string, fecha date, hora int, v double")
    other = DAY + datetime.timedelta(days=1)
    upsert_days(rows([("a", DAY, 1, 1.0), ("a", other, 1, 5.0)]), path)
    untouched = {f for f in spark.read.parquet(path).inputFiles() if str(other) in f}
    for _ in range(2):
        upsert_days(rows([("a", DAY, 1, 2.0), ("a", DAY, 2, 3.0)]), path)
    got = spark.read.parquet(path)
    assert values(got, "fecha", "hora", "v") == [(DAY, 1, 2.0), (DAY, 2, 3.0), (other, 1, 5.0)]
    assert untouched <= set(got.inputFiles())


def test_csv_keeps_header_and_accents(spark):
    path = shared_dir(spark, "t-csv")
    sk.write_csv(spark.createDataFrame([("Congestión, global", 0.5)], "KPI string, Valor double"), path)
    assert values(rd.read_csv(spark, path), "KPI", "Valor") == [("Congestión, global", 0.5)]


def test_stream_equals_batch_over_several_batches(spark):
    """Three runs of the same query; the change log keeps the newest version per key."""
    landed, log, check = (shared_dir(spark, n) for n in ("t-in", "t-log", "t-check"))
    everything = []
    for day, hour in ((27, 10), (28, 9), (28, 10)):
        part = [(z, stamp(day, hour, m), float(day + m)) for z in ("a", "b") for m in (1, 2, 3)]
        everything += part
        readings(spark, part).coalesce(1).write.mode("append").parquet(landed)
        hourly = st.hourly_stream(st.landed_stream(spark, landed, "zona string, _ingest_ts timestamp, v double"), ["v"])
        st.write_changes(hourly, log, check, once=True).awaitTermination()
    got = st.hourly_means(st.read_changes(spark, log, ["zona", "_hour"]), ["v"])
    batch = readings(spark, everything).groupBy("zona", F.to_date("_ingest_ts").alias("fecha"), F.hour("_ingest_ts").alias("hora")).agg(
        F.count(F.lit(1)).alias("n"), np_round(F.avg("v"), 3).alias("v")
    )
    assert values(got, "zona", "fecha", "hora", "n", "v") == values(batch, "zona", "fecha", "hora", "n", "v")


def test_closed_hours_leave_the_log(spark):
    """Folding keeps every hour, empties the log of closed ones, and may run twice."""
    landed, log, check, table = (shared_dir(spark, n) for n in ("t-in", "t-log", "t-check", "t-folded"))
    key, schema = ["zona", "_hour"], "zona string, _ingest_ts timestamp, v double"
    for day in (20, 21, 25):
        readings(spark, [("a", stamp(day, 10), float(day)), ("b", stamp(day, 11), 1.0)]).coalesce(1).write.mode("append").parquet(landed)
        hourly = st.hourly_stream(st.landed_stream(spark, landed, schema), ["v"])
        st.write_changes(hourly, log, check, once=True).awaitTermination()
    before = values(st.read_changes(spark, log, key), "zona", "_hour", "s_v")
    for _ in range(2):
        st.fold_closed(spark, log, table, key)
        assert values(st.read_folded(spark, log, table, key), "zona", "_hour", "s_v") == before
    assert {r[0] for r in values(spark.read.parquet(log), "_hour")} == {stamp(25, 10), stamp(25, 11)}
    assert len(before) == 6


def test_late_rows_beyond_a_day_are_ignored(spark):
    landed, log, check = (shared_dir(spark, n) for n in ("t-in", "t-log", "t-check"))
    for data in ([("a", stamp(20, 10), 1.0)], [("a", stamp(25, 10), 2.0)], [("a", stamp(20, 10, 5), 3.0), ("a", stamp(25, 9), 4.0)]):
        readings(spark, data).coalesce(1).write.mode("append").parquet(landed)
        hourly = st.hourly_stream(st.landed_stream(spark, landed, "zona string, _ingest_ts timestamp, v double"), ["v"])
        st.write_changes(hourly, log, check, once=True).awaitTermination()
    got = st.read_changes(spark, log, ["zona", "_hour"])
    assert values(got, "_hour", "s_v") == [(stamp(20, 10), 1.0), (stamp(25, 9), 4.0), (stamp(25, 10), 2.0)]


def test_duplicates_are_dropped_across_batches(spark):
    landed, out, check = (shared_dir(spark, n) for n in ("t-in", "t-out", "t-check"))
    for data in ([("a", stamp(28, 10), 1.0), ("b", stamp(28, 10), 2.0)], [("a", stamp(28, 10), 9.0), ("a", stamp(28, 11), 3.0)]):
        readings(spark, data).coalesce(1).write.mode("append").parquet(landed)
        unique = st.deduplicated(st.landed_stream(spark, landed, "zona string, _ingest_ts timestamp, v double"), ["zona", "_ingest_ts"])
        writer = unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
        st.triggered(writer, True, st.INGEST_EVERY).start().awaitTermination()
    assert values(spark.read.parquet(out), "zona", "v") == [("a", 1.0), ("a", 3.0), ("b", 2.0)]


def test_one_failing_source_does_not_stop_the_others(spark):
    landed, out = shared_dir(spark, "t-in"), shared_dir(spark, "t-out")
    readings(spark, [("a", stamp(28, 10), 1.0)]).write.parquet(landed)
    good = st.landed_stream(spark, landed, "zona string, _ingest_ts timestamp, v double")
    broken = good.withColumn("v", F.raise_error(F.lit("feed is down")).cast("double"))
    outcome = st.run_all(
        {
            "gps_rutas": lambda: st.ingest(broken, "gps_rutas", shared_dir(spark, "t-bad"), shared_dir(spark, "t-c1"), F.col("_ingest_ts"), once=True),
            "clima": lambda: st.ingest(good, "clima", out, shared_dir(spark, "t-c2"), F.col("_ingest_ts"), once=True),
            "eventos": lambda: (_ for _ in ()).throw(ValueError("cannot start")),
        }
    )
    assert outcome["clima"] is None and "feed is down" in outcome["gps_rutas"] and outcome["eventos"] == "cannot start"
    assert values(spark.read.parquet(out), "zona", "ingest_hour") == [("a", 10)]


def test_interval_streams_show_and_retry_a_late_failure(spark):
    """The first source never ends; the second fails twice and is started again each time."""
    landed = shared_dir(spark, "t-in")
    readings(spark, [("a", stamp(28, 10), 1.0)]).write.parquet(landed)
    good = st.landed_stream(spark, landed, "zona string, _ingest_ts timestamp, v double")
    broken = good.withColumn("v", F.raise_error(F.lit("feed is down")).cast("double"))
    begun = []

    def failing():
        begun.append(st.ingest(broken, "gps_rutas", shared_dir(spark, "t-bad"), shared_dir(spark, "t-c3"), F.col("_ingest_ts")))
        return begun[-1]

    outcome = st.run_all(
        {"clima": lambda: st.ingest(good, "clima", shared_dir(spark, "t-out"), shared_dir(spark, "t-c4"), F.col("_ingest_ts")), "gps_rutas": failing},
        retries=1,
        stop=lambda: len(begun) == 2 and not begun[1].isActive,
    )
    assert outcome["clima"] is None and "feed is down" in outcome["gps_rutas"] and len(begun) == 2


def test_days_of_another_time_zone_are_replaced_whole(spark):
    """24 readings of one local day over two UTC days, in two batches."""
    landed, target, check = (shared_dir(spark, n) for n in ("t-in", "t-gold", "t-check"))
    schema = "zona string, _ingest_ts timestamp, v double, ingest_date date"

    def rebuild(df):
        from citylake.functions.timegrain import add_time_grain

        return add_time_grain(df, "_ingest_ts", "America/Lima").groupBy("zona", "fecha", "hora").agg(F.count("*").alias("n"))

    for hours in ([(27, h) for h in range(5, 24)], [(28, h) for h in range(5)]):
        part = readings(spark, [("a", stamp(d, h), 1.0) for d, h in hours])
        part.withColumn("ingest_date", F.to_date("_ingest_ts")).write.mode("append").partitionBy("ingest_date").parquet(landed)
        stream = st.landed_stream(spark, landed, schema)
        st.refresh_days(stream, landed, target, check, rebuild, once=True).awaitTermination()
    assert values(spark.read.parquet(target), "hora") == [(h,) for h in range(24)]


def test_refresh_days_of_a_source_dated_ahead(spark):
    """Events landed on different days for the same event day stay together."""
    landed, target, check = (shared_dir(spark, n) for n in ("t-in", "t-gold", "t-check"))
    for landed_on in (1, 9):
        rows = spark.createDataFrame([(DAY, f"e{landed_on}", DAY - datetime.timedelta(days=landed_on))], "fecha date, nombre string, ingest_date date")
        rows.write.mode("append").partitionBy("ingest_date").parquet(landed)
        stream = st.landed_stream(spark, landed, "fecha date, nombre string, ingest_date date")
        rebuild = lambda df: df.select("nombre", "fecha")
        st.refresh_days(stream, landed, target, check, rebuild, once=True, margin=10).awaitTermination()
    assert values(spark.read.parquet(target), "nombre") == [("e1",), ("e9",)]


def test_working_copies_are_removed(spark, tmp_path, monkeypatch):
    from citylake.operators import upsert

    monkeypatch.setattr(upsert, "shared_dir", lambda _, purpose: str(tmp_path / "shared" / purpose))
    fresh = spark.createDataFrame([("a", DAY, 1, 1.0)], "zona string, fecha date, hora int, v double")
    upsert_days(fresh, str(tmp_path / "gold"))
    replace_days(fresh, str(tmp_path / "gold"))
    assert list((tmp_path / "shared").iterdir()) == []


def test_replaced_days_keep_nothing_of_the_old_ones(spark):
    path = shared_dir(spark, "t-gold")
    rows = lambda data: spark.createDataFrame(data, "zona string, fecha date, hora int, v double")
    replace_days(rows([("a", DAY, 1, 1.0), ("a", DAY, 2, 1.0)]), path)
    replace_days(rows([("a", DAY, 1, 2.0)]), path)
    assert values(spark.read.parquet(path), "hora", "v") == [(1, 2.0)]


def test_watermark_needs_a_real_timestamp(spark):
    assert "timestamp" in dict(st.with_event_time(spark.readStream.format("rate").load().select(F.col("timestamp").cast("timestamp_ntz").alias("_ingest_ts"))).dtypes)["_ingest_ts"]


def test_shared_dir_refuses_local_folders_on_a_cluster(monkeypatch, spark):
    class Fake:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:  # noqa: N801
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Fake, "x")
