"""Learned patterns: hourly profiles, weekday factors, class and event rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citylake.dims import EVENT_TYPES, SENTIMENTS
from citylake.functions.numeric import clip, exact_mean, share_of

LEVEL_PRIORS = {"alto": 0.33, "medio": 0.34, "bajo": 0.33}


def recent_or_wider(df: DataFrame, as_of: Column, days: int = 7, enough: int = 50, widen: int = 3, day: str = "fecha") -> DataFrame:
    """The last `days` days, or `widen` times as many if they hold too few rows.

    The count is a scalar subquery, so the choice is made inside one query.
    """
    near = df.filter(F.col(day) >= F.date_sub(as_of, days))
    n = near.limit(enough).agg(F.count(F.lit(1))).scalar()
    start = F.when(n < enough, F.date_sub(as_of, days * widen)).otherwise(F.date_sub(as_of, days))
    return df.filter(F.col(day) >= start)


def zone_hour_profile(
    df: DataFrame, metrics: list[str], floors: dict[str, float] | float = 0.01, digits: int = 4, at_least: int = 2
) -> DataFrame:
    """Count, mean and floored sample deviation of each metric per zone and hour."""

    def floor(m: str) -> float:
        return floors if isinstance(floors, float) else floors[m]

    return (
        df.groupBy("zona", "hora")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.coalesce(exact_mean(m, digits), F.lit(0.0)).alias(f"mean_{m}") for m in metrics],
            *[
                F.greatest(F.coalesce(F.stddev_samp(m), F.lit(0.01)), F.lit(floor(m))).alias(f"std_{m}")
                for m in metrics
            ],
        )
        .filter(F.col("n") >= at_least)
    )


# ---- fixed values: per source, metric -> default mean, default and least deviation ----
SOURCE_PROFILES: dict[str, dict[str, tuple[float, float | None, float | None]]] = {
    "sensores_trafico": {"congestion_ratio": (0.50, 0.06, 0.01), "intensidad_veh_hora": (400.0, 50.0, 1.0)},
    "gps_rutas": {"velocidad_kmh": (35.0, 5.0, 0.5), "congestion_factor": (2.0, 0.3, 0.05)},
    "vision_camaras": {"total_detectado": (200.0, 30.0, 1.0)},
    "clima": {
        "temperatura_c": (20.0, 1.5, 0.2),
        "humedad_pct": (75.0, 6.0, 0.5),
        "precipitacion_mm": (0.1, None, None),
        "viento_kmh": (12.0, 3.0, 0.3),
    },
}
# Rates where a source has no rows at all.
NO_EVENTS = 0.15
NO_NEWS = {"n_por_lote": 5.0, "pct_trafico": 0.6, "sentiment": (0.2, 0.5, 0.3)}
# ---- end of fixed values ------------------------------------------------------


def source_profile(df: DataFrame, metrics: dict[str, tuple[float, float | None, float | None]], keys: DataFrame, digits: int = 6) -> DataFrame:
    """Mean and deviation of a source's metrics for every zone of `keys` and every hour.

    Rows without a weight complete the grid, so there is no join. Where a metric was
    never seen its defaults stand; a deviation is never below its floor.
    """
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hora")
    rows = df.select("zona", "hora", *metrics, F.lit(1).alias("_w"))
    rows = rows.join(keys.select("zona"), "zona", "left_semi").unionByName(keys.select("zona", hours), allowMissingColumns=True)
    out = [F.count("_w").alias("n")]
    for name, (mean, deviation, floor) in metrics.items():
        out.append(F.coalesce(exact_mean(name, digits), F.lit(mean)).alias(f"mean_{name}"))
        if deviation is not None:
            spread = F.coalesce(F.stddev_samp(name), F.lit(deviation))
            out.append(F.greatest(spread, F.lit(floor)).alias(f"std_{name}"))
    return rows.groupBy("zona", "hora").agg(*out)


def weekday_factors(df: DataFrame, metric: str = "congestion_ratio", digits: int = 4) -> DataFrame:
    """Weekday mean over overall mean; a weekday without data gets 1.0.

    Seven literal zero-weight rows make the week complete without a join.
    """
    overall = df.agg(exact_mean(metric, digits)).scalar()
    week = df.sparkSession.range(7).select(F.col("id").cast("int").alias("dia_semana"))
    united = df.select("dia_semana", metric).unionByName(week, allowMissingColumns=True)
    by_day = united.groupBy("dia_semana").agg(exact_mean(metric, digits).alias("m"))
    return by_day.select("dia_semana", F.coalesce(F.try_divide(F.col("m"), overall), F.lit(1.0)).alias("factor"))


def class_probabilities(
    df: DataFrame, priors: dict[str, float] = LEVEL_PRIORS, at_least: int = 3, keys: DataFrame | None = None
) -> DataFrame:
    """Label probabilities per zone and hour, renormalised.

    Too few rows give the priors; a label never seen takes its prior as well. Every
    zone of `keys` gets all 24 hours; the rows added for that weigh nothing.
    """
    rows = df.select("zona", "hora", "nivel_congestion", F.lit(1).alias("_w"))
    if keys is not None:
        hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hora")
        rows = rows.unionByName(keys.select("zona", hours), allowMissingColumns=True)
    counted = rows.groupBy("zona", "hora").agg(
        F.count("_w").alias("n"),
        F.count("nivel_congestion").alias("labelled"),
        *[F.count_if(F.col("nivel_congestion") == c).alias(f"n_{c}") for c in priors],
    )
    return probabilities_of(counted, priors, at_least)


def probabilities_of(counted: DataFrame, priors: dict[str, float] = LEVEL_PRIORS, at_least: int = 3) -> DataFrame:
    """Probabilities from counts per zone and hour (n, labelled, one per label)."""
    raw = {
        f"p_{c}": F.when(
            (F.col("n") >= at_least) & (F.col(f"n_{c}") > 0), F.try_divide(F.col(f"n_{c}"), F.col("labelled"))
        ).otherwise(F.lit(p))
        for c, p in priors.items()
    }
    filled = counted.withColumns(raw)
    names = list(raw)
    total = sum([F.col(c) for c in names[1:]], F.col(names[0]))
    return filled.withColumn("_t", total).select("zona", "hora", "n", *[(F.col(c) / F.col("_t")).alias(c) for c in names])


# ---- moments per day: every window is a merge of its days ----------------------------


def day_moments(df: DataFrame, metrics: list[str], digits: int = 4, labels: list[str] = list(LEVEL_PRIORS)) -> DataFrame:
    """Per day, zone and hour: rows, label counts, and of every metric count, sum (a scaled
    integer, for metrics of so many digits), mean, and squares centred on that mean."""
    return df.groupBy("fecha", "zona", "hora").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("nivel_congestion").alias("labelled"),
        *[F.count_if(F.col("nivel_congestion") == c).alias(f"n_{c}") for c in labels],
        *[F.count(m).alias(f"c_{m}") for m in metrics],
        *[F.sum(F.rint(F.col(m) * float(10**digits)).cast("bigint")).alias(f"s_{m}") for m in metrics],
        *[F.avg(m).alias(f"u_{m}") for m in metrics],
        *[F.regr_sxx(m, m).alias(f"q_{m}") for m in metrics],
    )


def merged_moments(moments: DataFrame, first, last, metrics: list[str], digits: int = 4) -> DataFrame:
    """One row per zone and hour over the days first..last, with mean_ and std_ of each metric.

    The squares of all days together are those inside the days, and for each day the distance
    of its mean from the mean of all, so no difference of large sums is taken. A window
    group holds one row per day, however many readings a day had, and the aggregation that
    follows has the same key: one exchange in all."""
    whole = Window.partitionBy("zona", "hora")
    scale = float(10**digits)

    def mean(s: Column, c: Column) -> Column:
        return F.try_divide(s.cast("double"), (c * int(scale)).cast("double"))

    def squares(m: str) -> Column:
        u, c = F.col(f"u_{m}"), F.col(f"c_{m}")
        gap = u - F.try_divide(F.sum(u * c).over(whole), F.sum(c).over(whole))
        return F.col(f"q_{m}") + c * gap * gap

    near = moments.filter(F.col("fecha").between(first, last)).withColumns({f"q_{m}": squares(m) for m in metrics})
    summed = [c for c in near.columns if c in ("n", "labelled") or c.startswith(("n_", "c_", "s_", "q_"))]
    merged = near.groupBy("zona", "hora").agg(*[F.sum(c).alias(c) for c in summed])
    means = {f"mean_{m}": mean(F.col(f"s_{m}"), F.col(f"c_{m}")) for m in metrics}
    spread = {f"std_{m}": F.when(F.col(f"c_{m}") > 1, F.sqrt(F.col(f"q_{m}") / (F.col(f"c_{m}") - 1))) for m in metrics}
    return merged.withColumns({**means, **spread})


def profile_of(merged: DataFrame, metrics: list[str], floor: float = 0.01, at_least: int = 2) -> DataFrame:
    """The zone-hour profile from merged moments."""
    return merged.filter(F.col("n") >= at_least).select(
        "zona",
        "hora",
        "n",
        *[F.coalesce(f"mean_{m}", F.lit(0.0)).alias(f"mean_{m}") for m in metrics],
        *[F.greatest(F.coalesce(f"std_{m}", F.lit(0.01)), F.lit(floor)).alias(f"std_{m}") for m in metrics],
    )


def weekday_factors_of(moments: DataFrame, first, last, metric: str = "congestion_ratio") -> DataFrame:
    """Weekday factors of a window from day moments: the weekday follows from the day."""
    days = moments.filter(F.col("fecha").between(first, last)).groupBy(F.weekday("fecha").alias("dia_semana"))
    days = days.agg(F.sum(f"s_{metric}").alias("s"), F.sum(f"c_{metric}").alias("c"))

    def mean(s: Column, c: Column) -> Column:
        return F.try_divide(s.cast("double"), c.cast("double"))

    overall = days.agg(mean(F.sum("s"), F.sum("c"))).scalar()
    week = moments.sparkSession.range(7).select(F.col("id").cast("int").alias("dia_semana"))
    factor = F.try_divide(mean(F.col("s"), F.col("c")), overall)
    return week.join(days, "dia_semana", "left").select("dia_semana", F.coalesce(factor, F.lit(1.0)).alias("factor"))


def event_rate(events: DataFrame, zones: int, types: list[str] = EVENT_TYPES, cap: float | None = None) -> DataFrame:
    """Events per zone and day with the distribution of types.

    Unseen types get an even share before renormalising. `cap` bounds the rate for
    callers that use it as a probability.
    """
    even = 1.0 / len(types)
    counts = events.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("tipo").alias("typed"),
        F.countDistinct("fecha").alias("days"),
        *[F.count_if(F.col("tipo") == t).alias(f"n_{t}") for t in types],
    )
    seen = clip(F.col("n") / F.greatest(F.col("days") * zones, F.lit(1)), None, cap)
    prob = F.when(F.col("n") == 0, F.lit(NO_EVENTS)).otherwise(seen)
    shares = [
        F.when(F.col(f"n_{t}") > 0, F.try_divide(F.col(f"n_{t}"), F.col("typed"))).otherwise(F.lit(even)) for t in types
    ]
    total = sum(shares[1:], shares[0])
    rows = F.array(*[F.struct(F.lit(t).alias("tipo"), (s / F.col("_t")).alias("prob_tipo")) for t, s in zip(types, shares)])
    return counts.withColumn("prob_evento", prob).withColumn("_t", total).select("prob_evento", F.inline(rows))


def news_rate(news: DataFrame, batch: str = "_ingest_ts", low: float | None = None, high: float | None = None) -> DataFrame:
    """Items per batch (bounded where asked), sentiment distribution, share of traffic items."""
    counts = news.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("sentiment").alias("felt"),
        F.countDistinct(batch).alias("batches"),
        F.count_if(F.col("es_trafico")).alias("traffic"),
        *[F.count_if(F.col("sentiment") == s).alias(f"n_{s}") for s in SENTIMENTS],
    )
    shares = [
        F.when(F.col(f"n_{s}") > 0, F.try_divide(F.col(f"n_{s}"), F.col("felt"))).otherwise(F.lit(1.0 / 3))
        for s in SENTIMENTS
    ]
    none, total = F.col("n") == 0, sum(shares[1:], shares[0])
    rate = clip(F.col("n") / F.greatest(F.col("batches"), F.lit(1)), low, high)
    return counts.withColumn("_t", total).select(
        F.when(none, F.lit(NO_NEWS["n_por_lote"])).otherwise(rate).alias("n_por_lote"),
        F.when(none, F.lit(NO_NEWS["pct_trafico"])).otherwise(F.try_divide(F.col("traffic"), F.col("n"))).alias("pct_trafico"),
        *[
            F.when(none, F.lit(p)).otherwise(s / F.col("_t")).alias(f"p_{name}")
            for s, name, p in zip(shares, SENTIMENTS, NO_NEWS["sentiment"])
        ],
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency and share of each value, most frequent first.

    The total is the sum of the counts, whose exchange Spark reuses: no second scan.
    """
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("proporcion", F.col("n") / total).orderBy(F.desc("n"), column)


def level_shares(levels: list[str]) -> list[Column]:
    return [share_of(F.col("nivel_congestion") == v).alias(f"pct_{v}") for v in levels]
