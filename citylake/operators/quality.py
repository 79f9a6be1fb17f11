"""Cleaning rules: required fields, first-wins dedup, casts, ranges, reports."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citylake.functions.numeric import lenient_int, np_round, null_to_false


@dataclass(frozen=True)
class CleanRule:
    """What a silver table demands of its bronze rows."""

    required: tuple[str, ...]
    key: tuple[str, ...]
    integers: dict[str, str] = field(default_factory=dict)
    casts: dict[str, str] = field(default_factory=dict)
    flags: tuple[str, ...] = ()
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    sort: tuple[str, ...] = ()
    report_field: str = ""


def first_row(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """The first row per key in an explicit order.

    Spark limits each task to one row per key before the shuffle
    (WindowGroupLimit), so a key that holds a large part of the data travels as
    one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rn", rank).filter("_rn = 1").drop("_rn")


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with all listed fields present (readers have turned NaN into NULL).

    Plain IS NOT NULL predicates reach the Parquet scan, which `dropna` does not.
    """
    return reduce(lambda d, c: d.filter(F.col(c).isNotNull()), columns, df)


def in_range(column: str, low: float | None, high: float | None) -> Column:
    c = F.col(column)
    if low is not None and high is not None:
        return c.between(low, high)
    return c >= low if low is not None else c <= high


def apply_ranges(df: DataFrame, ranges: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Inclusive bounds; a NULL metric fails them."""
    return reduce(lambda d, item: d.filter(in_range(item[0], *item[1])), ranges.items(), df)


def clean(df: DataFrame, rule: CleanRule, order: list[str] | None = None, storage: bool = False) -> DataFrame:
    """Required fields, dedup, casts, ranges, in that order: a bad first reading
    evicts its later duplicate, it does not make room for it.

    Without an explicit order the remaining columns decide which duplicate is
    first, so the outcome does not depend on file order. 32-bit floats are a
    storage type: they stay double until a table is written (`storage`).
    """
    have = set(df.columns)
    tie = order or ["_ingest_ts", *[c for c in df.columns if c not in rule.key]]
    kept = first_row(require(df, list(rule.required)), list(rule.key), [c for c in tie if c in have])
    typed = {c: lenient_int(c, t) for c, t in rule.integers.items() if c in have}
    for c, t in rule.casts.items():
        if c in have:
            typed[c] = F.col(c).cast("double" if t == "float" and not storage else t)
    typed |= {c: null_to_false(F.col(c).cast("boolean")) for c in rule.flags if c in have}
    return apply_ranges(kept.withColumns(typed) if typed else kept, rule.ranges)


def quality_report(sources: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Rows in and out per source: name -> (bronze, silver, key field).

    Each side is one pass; the partial counts are united and summed per source.
    """
    parts = []
    for name, (bronze, silver, key) in sources.items():
        tag = [F.lit(name).alias("fuente"), F.lit(key).alias("campo_clave")]
        declared = F.min("_calidad_fuente") if "_calidad_fuente" in bronze.columns else F.lit("?")
        n = F.count(F.lit(1))
        parts.append(
            bronze.agg(n.alias("n_in"), declared.alias("calidad_fuente")).select(
                *tag, "n_in", F.lit(0).cast("bigint").alias("n_out"), F.lit(0).cast("bigint").alias("n_null"), "calidad_fuente"
            )
        )
        parts.append(
            silver.agg(n.alias("n_out"), F.count_if(F.col(key).isNull()).alias("n_null")).select(
                *tag, F.lit(0).cast("bigint").alias("n_in"), "n_out", "n_null", F.lit(None).cast("string").alias("calidad_fuente")
            )
        )
    united = reduce(DataFrame.unionByName, parts)
    total = united.groupBy("fuente", "campo_clave").agg(
        F.sum("n_in").alias("registros_bronze"),
        F.sum("n_out").alias("registros_silver"),
        F.sum("n_null").alias("nulos_campo_clave"),
        F.coalesce(F.max("calidad_fuente"), F.lit("?")).alias("calidad_fuente"),
    )
    kept = F.coalesce(np_round(F.try_divide(F.col("registros_silver") * 100.0, F.col("registros_bronze")), 1), F.lit(0.0))
    return total.withColumn("descartados", F.col("registros_bronze") - F.col("registros_silver")).withColumn(
        "pct_retenidos", kept
    )


def stored_report(sources: dict[str, tuple[DataFrame, DataFrame, str, str]]) -> DataFrame:
    """The same report from written tables: name -> (bronze, silver, key field, declared quality).

    A bare count reads no column: Parquet's footers hold the row counts. Of silver only the
    key field is read. Nothing is cleaned again to be counted, and a task that runs twice
    counts what is in the files."""
    rows = {}
    for name, (bronze, silver, key, quality) in sources.items():
        tag = [F.lit(name).alias("fuente"), F.lit(key).alias("campo_clave"), F.lit(quality).alias("calidad_fuente")]
        n_in = bronze.agg(F.count(F.lit(1)).alias("n")).scalar()
        counts = silver.agg(F.count(F.lit(1)).alias("n_out"), F.count(key).alias("n_key"))
        rows[name] = counts.select(*tag, n_in.alias("n_in"), "n_out", "n_key")
    kept = F.coalesce(np_round(F.try_divide(F.col("n_out") * 100.0, F.col("n_in")), 1), F.lit(0.0))
    return reduce(DataFrame.unionByName, rows.values()).select(
        "fuente",
        "campo_clave",
        F.col("n_in").alias("registros_bronze"),
        F.col("n_out").alias("registros_silver"),
        (F.col("n_out") - F.col("n_key")).alias("nulos_campo_clave"),
        "calidad_fuente",
        (F.col("n_in") - F.col("n_out")).alias("descartados"),
        kept.alias("pct_retenidos"),
    )


def null_report(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Nulls per column, tagged with its schema group; one pass over the table."""
    pairs = [(g, c) for g, cols in groups.items() for c in cols if c in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for _, c in pairs])
    rows = F.array(*[F.struct(F.lit(g).alias("grupo"), F.lit(c).alias("columna"), F.col(c).alias("nulos")) for g, c in pairs])
    return counts.select(F.inline(rows))


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill NULLs and create columns that are absent."""
    have = set(df.columns)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) if c in have else F.lit(v) for c, v in defaults.items()}
    )


def union_common(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION ALL on the columns both sides have."""
    shared = [c for c in left.columns if c in set(right.columns)]
    return left.select(*shared).unionByName(right.select(*shared))
