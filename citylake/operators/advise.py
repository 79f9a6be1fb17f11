"""Route advice and signal timing from the hourly gold table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.dims import ALTERNATIVES, CAPACITY, GREEN_BASE, SIGNAL_IMPACT
from citylake.functions.numeric import lookup, np_round
from citylake.functions.traffic import advice_status, green_seconds, minutes_saved, signal_action

LEVELS = ["bajo", "medio", "alto"]
FACTS = ["congestion_factor", "indice_congestion", "velocidad_kmh", "duracion_trafico_s"]
#: More than the places in any zone's list of alternatives.
PLACES = 1024


def serves_as_alternative(alternatives: dict[str, list[str]]) -> dict[str, list[tuple[str, int]]]:
    """Zone -> zones that list it as an alternative, with its place in their list."""
    out: dict[str, list[tuple[str, int]]] = {}
    for zone, options in alternatives.items():
        for place, option in enumerate(options):
            out.setdefault(option, []).append((zone, place))
    return out


def with_alternatives(gold: DataFrame, alternatives: dict[str, list[str]] = ALTERNATIVES) -> DataFrame:
    """Each zone-hour next to its best alternative at the same hour.

    Instead of joining the table with itself, every row is sent once to its own
    zone and once to each zone it can relieve; a single shuffle on
    (zona, fecha, hora) then brings a row and its candidates together. A group
    holds one own row and at most as many candidates as the zone has neighbours.

    Factor (three decimals, as the hourly table has them) and place in the list are
    packed into one long that orders as the pair does, and levels travel as numbers, so
    the aggregation stays in a hash table. The name of the best follows from its place.
    """

    def target(zone: str, place: int):
        return F.struct(F.lit(zone).alias("a"), F.lit(place).alias("prio"))

    reached = F.array(F.struct(F.col("zona").alias("a"), F.lit(-1).alias("prio")))
    for zone, served in serves_as_alternative(alternatives).items():
        reached = F.when(F.col("zona") == zone, F.array(target(zone, -1), *[target(*s) for s in served])).otherwise(reached)

    # A stored factor of 0 means "not measured" and falls back to the index.
    usable = F.when(F.col("congestion_factor") == 0, F.col("indice_congestion")).otherwise(F.col("congestion_factor"))
    level = F.array_position(F.array(*[F.lit(v) for v in LEVELS]), F.col("nivel_congestion")).cast("int")
    sent = gold.select(
        F.explode(reached).alias("t"), "fecha", "hora", level.alias("level"), usable.alias("usable"), *[F.col(c).cast("double") for c in FACTS]
    ).select(F.col("t.a").alias("zona"), F.col("t.prio").alias("prio"), "fecha", "hora", "level", "usable", *FACTS)
    own, values = F.col("prio") < 0, ["level", "usable", *FACTS]
    rank = F.rint(F.col("usable") * 1000).cast("bigint") * PLACES + F.col("prio")
    rank = F.when(~own & F.col("usable").isNotNull(), rank)
    best = sent.groupBy("zona", "fecha", "hora").agg(
        F.count_if(own).alias("owns"),
        F.min(rank).alias("rank"),
        *[F.max(F.when(own, F.col(c))).alias(f"own_{c}") for c in values],
        *[F.min_by(c, rank).alias(f"alt_{c}") for c in values],
    )
    options = F.create_map(*[x for z, names in alternatives.items() for x in (F.lit(z), F.array(*[F.lit(n) for n in names]))])
    chosen = F.get(F.try_element_at(options, F.col("zona")), F.pmod(F.col("rank"), F.lit(PLACES)).cast("int"))

    def facts(side: str, zone) -> Column:
        name = F.get(F.array(*[F.lit(v) for v in LEVELS]), F.col(f"{side}_level") - 1)
        columns = [F.col(f"{side}_{c}").alias(c) for c in FACTS]
        return F.struct(
            F.struct(zone.alias("zona"), name.alias("nivel_congestion"), *columns).alias("facts"), F.col(f"{side}_usable").alias("usable")
        )

    return best.filter((F.col("owns") > 0) & F.col("rank").isNotNull()).select(
        "zona", "fecha", "hora", facts("own", F.col("zona")).alias("own"), facts("alt", chosen).alias("alt")
    )


def route_advice(gold: DataFrame, alternatives: dict[str, list[str]] = ALTERNATIVES) -> DataFrame:
    pair = with_alternatives(gold, alternatives)
    own, alt = "own.facts", "alt.facts"
    return pair.select(
        "zona",
        "fecha",
        "hora",
        F.col(f"{own}.nivel_congestion").alias("nivel_congestion_actual"),
        np_round(F.col(f"{own}.congestion_factor"), 3).alias("congestion_factor_actual"),
        np_round(F.col(f"{own}.velocidad_kmh"), 1).alias("velocidad_actual_kmh"),
        F.col(f"{alt}.zona").alias("ruta_alternativa"),
        F.col(f"{alt}.nivel_congestion").alias("nivel_alternativa"),
        np_round(F.col("alt.usable"), 3).alias("congestion_factor_alt"),
        np_round(F.col(f"{alt}.velocidad_kmh"), 1).alias("velocidad_alt_kmh"),
        minutes_saved(F.col(f"{own}.duracion_trafico_s"), F.col(f"{alt}.duracion_trafico_s")).alias("ahorro_estimado_min"),
        advice_status(F.col("own.usable"), F.col("alt.usable"), F.col(f"{alt}.nivel_congestion")).alias("estado"),
    )


def signal_timing(gold: DataFrame) -> DataFrame:
    ratio = F.col("ratio_flujo_camara")
    action = signal_action(ratio)
    return gold.select(
        "zona",
        "fecha",
        "hora",
        "nivel_congestion",
        "vehiculos_entrada",
        "vehiculos_salida",
        "ratio_flujo_camara",
        "congestion_factor",
        "indice_congestion",
        lookup("zona", CAPACITY).alias("capacidad_ref"),
        green_seconds(ratio).alias("verde_recomendado_s"),
        F.lit(GREEN_BASE).alias("verde_actual_estimado_s"),
        (green_seconds(ratio) - GREEN_BASE).alias("ajuste_verde_s"),
        action.alias("accion_semaforo"),
        lookup(action, SIGNAL_IMPACT).alias("impacto_estimado"),
    )
