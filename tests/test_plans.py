"""What the optimizer makes of the operators (test_oracle checks every query's plan too)."""

import re

from pyspark.sql import functions as F

from citylake.catalog.products import cleaned, gold
from citylake.catalog.views import readings, table
from citylake.operators.measures import top_with_ties
from citylake.operators.quality import first_row, require
from citylake.plans.gold import join_sources

def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_rows_before_the_shuffle(spark, sf_dir):
    text = plan(first_row(readings(spark, sf_dir), ["zona", "_ingest_ts"], ["event_id"]))
    exchange = text.index("Exchange hashpartitioning")
    assert re.search(r"WindowGroupLimit .*Partial", text[exchange:])


def test_required_fields_and_columns_reach_the_scan(spark, sf_dir):
    df = require(table(spark, sf_dir, "orders"), ["o_custkey"]).filter(F.col("o_totalprice") >= 100.0).select("o_custkey")
    text = plan(df)
    assert "IsNotNull(o_custkey)" in text and "GreaterThanOrEqual(o_totalprice,100.0)" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_gold_joins_reuse_the_rollup_partitioning(spark, sf_dir):
    """With broadcasts off, the three hour-level joins must add no exchange of their own."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        silver = cleaned(spark, sf_dir, "clima", "sensores_trafico", "gps_rutas", "vision_camaras")
        text = plan(join_sources(silver))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 3
    # Per source: one exchange for dedup and one for the roll-up; cameras have a batch level more.
    assert text.count("Exchange hashpartitioning") == 9


def test_gold_scans_only_needed_columns(spark, sf_dir):
    text = plan(gold(spark, sf_dir))
    assert "event_type" not in "".join(re.findall(r"ReadSchema: struct<[^>]*>", text))


def test_ties_are_filtered_where_they_are(spark, sf_dir):
    text = plan(top_with_ties(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size", 3))
    assert "Window" not in text and "TakeOrderedAndProject" in text


def executed(df) -> str:
    """The final plan of a query that ran."""
    running = df._jdf.queryExecution()
    running.executedPlan().executeCollectPublic()
    return running.executedPlan().toString()


def test_value_counts_scan_once(spark, sf_dir):
    from citylake.operators.profile import value_counts

    text = executed(value_counts(table(spark, sf_dir, "orders"), "o_orderpriority"))
    assert "ReusedExchange" in text


def test_newest_values_stay_in_hash_tables(spark, sf_dir):
    from citylake.operators.kpi import zone_kpis

    base = gold(spark, sf_dir)
    text = plan(zone_kpis(base, latest_speed=True))
    assert "max_by(velocidad_kmh" in text
    assert text.count("SortAggregate") == plan(base.select("zona", "velocidad_kmh")).count("SortAggregate")


def test_strongest_events_are_limited_before_the_shuffle(spark, sf_dir):
    from citylake.operators.rollup import strongest_events

    text = plan(strongest_events(cleaned(spark, sf_dir, "eventos")["eventos"]))
    assert "SortAggregate" not in text and text.count("WindowGroupLimit") >= 4


def test_route_advice_stays_in_hash_tables(spark, sf_dir, tmp_path):
    from citylake.operators.advise import route_advice

    gold(spark, sf_dir).write.parquet(str(tmp_path / "gold"))
    text = plan(route_advice(spark.read.parquet(str(tmp_path / "gold"))))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2 and text.count("Exchange") == 1
