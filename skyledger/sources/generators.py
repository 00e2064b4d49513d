"""Synthetic flights and tracking events.

Every field is drawn from a digest of (seed, key, field group), so a row is the
same whatever the partitioning, on every run and after a task is repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.schemas import CSV_ORDER

# The domains of the historical flights.
PREFIXES = ["AA", "LA", "IB", "DL"]
AIRLINES = ["AirCorp", "AeroSky", "GlobalAir", "FlyFast"]
AIRPORTS = ["SCL", "MIA", "JFK", "MAD", "BUE", "LIM", "FRA", "CDG"]
PLANES = {"B787": 300, "A320": 180, "B737": 210, "A380": 550}
LONG_HAUL = ["B787", "A380"]
FARE_CLASSES = ["Económica", "Negocios", "Primera"]
# Fare and tax range of each class.
FARES = {
    "Económica": ((150, 600), (50, 100)),
    "Negocios": ((800, 2500), (100, 300)),
    "Primera": ((3000, 8000), (300, 800)),
}
FIRST_DAY = dt.date(2025, 1, 1)
DAYS = 366

# The domains of the tracking events.
STATES = ["En Vuelo", "Aterrizado", "Retrasado", "Cancelado", "Puerta Asignada"]
GATES = ["A", "B", "C"]
EVENT_ROUTE = "SCL->MIA"
CANCELLED_DELAY = 999


def pick(values: Sequence, index: Column) -> Column:
    """Element ``index`` modulo the length of a short literal list."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (index % len(values)).cast("int") + 1)


def draws(seed: int, *key: Column, groups: int) -> list[Column]:
    """Independent 32-bit numbers for a row, four per digest."""
    numbers = []
    for group in range(groups):
        text = F.concat_ws(":", F.lit(str(seed)), *(k.cast("string") for k in key), F.lit(str(group)))
        digest = F.md5(text)
        for word in range(4):
            numbers.append(F.conv(F.substring(digest, 8 * word + 1, 8), 16, 10).cast("bigint"))
    return numbers


def _between(draw: Column, low: int, high: int) -> Column:
    """Whole number from ``low`` to ``high``, both possible."""
    return draw % (high - low + 1) + low


def _money(draw: Column, bounds: tuple[int, int]) -> Column:
    cents = _between(draw, bounds[0] * 100, bounds[1] * 100)
    return (cents.cast("decimal(10,0)") * F.lit(Decimal("0.01"))).cast("decimal(12,2)")


def _by_class(fare_class: Column, draw: Column, part: int) -> Column:
    amount = F.lit(None).cast("decimal(12,2)")
    for name, bounds in FARES.items():
        amount = F.when(fare_class == name, _money(draw, bounds[part])).otherwise(amount)
    return amount


def flights_for(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """One flight for each row of ``keys``, in the historical column order."""
    d = draws(seed, F.col(key), groups=3)
    drawn = keys.select(
        F.concat(pick(PREFIXES, d[0]), _between(d[1], 100, 9999).cast("string")).alias("ID_Vuelo"),
        pick(AIRLINES, d[2]).alias("Aerolinea"),
        (d[3] % len(AIRPORTS)).alias("origin"),
        # One of the seven other airports: a step of 1 to 7 around the list.
        _between(d[4], 1, len(AIRPORTS) - 1).alias("step"),
        F.date_add(F.lit(FIRST_DAY), (d[5] % DAYS).cast("int")).alias("Fecha_Programada"),
        F.concat(
            F.lpad((d[6] % 24).cast("string"), 2, "0"), F.lit(":"), pick(["00", "30"], d[7])
        ).alias("Hora_Salida_UTC"),
        pick(list(PLANES), d[8]).alias("Tipo_Avion"),
        pick(list(PLANES.values()), d[8]).alias("Capacidad_Pasajeros"),
        _between(d[9], 6000, 10000).alias("load"),
        d[10].alias("leg"),
        pick(FARE_CLASSES, d[11]).alias("Clase_Tarifa"),
        F.col(key).alias("_key"),
    )
    money = draws(seed + 1, F.col("_key"), groups=1)
    return drawn.select(
        "*",
        pick(AIRPORTS, F.col("origin")).alias("Origen"),
        pick(AIRPORTS, F.col("origin") + F.col("step")).alias("Destino"),
        F.floor(F.col("Capacidad_Pasajeros") * F.col("load") / 10000)
        .cast("int")
        .alias("Pasajeros_Reservados"),
        F.when(F.col("Tipo_Avion").isin(*LONG_HAUL), _between(F.col("leg"), 2000, 10000))
        .otherwise(_between(F.col("leg"), 500, 4500))
        .cast("int")
        .alias("Distancia_KM"),
        _by_class(F.col("Clase_Tarifa"), money[0], 0).alias("Costo_Base"),
        _by_class(F.col("Clase_Tarifa"), money[1], 1).alias("Impuestos"),
    ).select(*CSV_ORDER)


def generate_flights(spark: SparkSession, rows: int, seed: int = 42) -> DataFrame:
    return flights_for(spark.range(rows), "id", seed)


def events_for(
    flights: DataFrame,
    *,
    key: Sequence[str] = ("ID_Vuelo", "Fecha_Programada", "Hora_Salida_UTC"),
    mean: int = 2,
    damaged_per_mille: int = 0,
    start: dt.datetime = dt.datetime(2025, 1, 1),
    span_seconds: int = 365 * 86400,
    seed: int = 42,
) -> DataFrame:
    """Tracking events of random flights, as JSON in a binary ``body``.

    Each flight has 0 to ``2 * mean`` events, so drawing a flight needs no join
    and no row numbers. ``damaged_per_mille`` of the events get a fault that the
    cleaning rules exist for: a corrupt id, a blank id, no time, or a late state
    without delay.
    """
    count = draws(seed, *(F.col(c) for c in key), groups=1)[0] % (2 * mean + 1)
    numbers = F.when(count > 0, F.sequence(F.lit(1), count.cast("int")))
    events = flights.select(*key, F.explode(numbers).alias("slot"))
    return _bodies(events, [*key, "slot"], damaged_per_mille, start, span_seconds, seed)


def numbered(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """The distinct values of a text column with a gapless ``number`` from 0, and how
    many they are. Numbers are given out within 4,096 groups by digest, each of which
    starts where the one before ends, so no task sorts all values."""
    values = df.select(key).where(F.col(key).isNotNull()).distinct()
    values = values.withColumn("_group", F.substring(F.md5(F.col(key)), 1, 3))
    sizes = values.groupBy("_group").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_group").orderBy(key)) - 1
    rows = (
        values.withColumn("_place", place)
        .join(F.broadcast(starts), "_group")
        .select(key, (F.col("_start") + F.col("_place")).alias("number"))
    )
    return rows, sizes.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]


def one_event_each(
    slots: DataFrame,
    slot: str,
    flights: DataFrame,
    *,
    heavy_per_mille: int = 0,
    damaged_per_mille: int = 0,
    start: dt.datetime = dt.datetime(2025, 1, 1),
    span_seconds: int = 365 * 86400,
    seed: int = 42,
) -> DataFrame:
    """One event of a random known flight for each row of ``slots``; none without flights.

    ``heavy_per_mille`` of the events are of one flight, for trials with an uneven
    key. A flight is drawn by its number, so the flights are joined once, broadcast
    if they are small and otherwise as an equi-join that adaptive execution splits.
    """
    known, size = numbered(flights, "ID_Vuelo")
    choice = draws(seed + 3, F.col(slot), groups=1)
    drawn = F.when(choice[0] % 1000 < heavy_per_mille, 0).otherwise(choice[1] % max(size, 1))
    events = slots.select(F.col(slot).alias("slot"), drawn.alias("number")).join(known, "number")
    return _bodies(events, ["slot"], damaged_per_mille, start, span_seconds, seed)


def generate_events(spark: SparkSession, n: int, flights: DataFrame, **how) -> DataFrame:
    """``n`` events of random flights; see ``one_event_each``."""
    return one_event_each(spark.range(n), "id", flights, **how)


def _bodies(
    events: DataFrame,
    key: Sequence[str],
    damaged_per_mille: int,
    start: dt.datetime,
    span_seconds: int,
    seed: int,
) -> DataFrame:
    """The JSON of one event for each row, which ``key`` tells from all others."""
    d = draws(seed + 2, *(F.col(c) for c in key), groups=3)
    fault = F.when(d[8] % 1000 < damaged_per_mille, d[9] % 4).otherwise(F.lit(-1))
    moment = F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(secs=d[0] % span_seconds)
    drawn = events.select(
        "ID_Vuelo",
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
        F.when(fault == 3, "Retrasado").otherwise(pick(STATES, d[1])).alias("state"),
        _between(d[2], 15, 180).alias("late_by"),
        _between(d[3], 2, 3).alias("late_level"),
        F.concat(pick(GATES, d[4]), _between(d[5], 1, 20).cast("string")).alias("gate"),
        (_between(d[6], 500_000, 3_000_000) / 100).cast("float").alias("fuel"),
        fault.alias("fault"),
    )
    late, cancelled = F.col("state") == "Retrasado", F.col("state") == "Cancelado"
    fault = F.col("fault")
    message = F.struct(
        F.when(fault == 0, F.concat("ID_Vuelo", F.lit("_ERR")))
        .when(fault == 1, "  ")
        .otherwise(F.col("ID_Vuelo"))
        .alias("ID_Vuelo"),
        F.when(fault != 2, F.col("at")).alias("Timestamp_Evento"),
        F.col("state").alias("Estado_Actual"),
        F.when(fault == 3, 0)
        .when(late, F.col("late_by"))
        .when(cancelled, CANCELLED_DELAY)
        .otherwise(0)
        .alias("Retraso_Minutos"),
        F.col("gate").alias("Puerta_Asignada"),
        F.lit(EVENT_ROUTE).alias("Ruta_Evento"),
        F.when(late, F.col("late_level")).when(cancelled, 3).otherwise(1).alias("Nivel_Servicio"),
        F.col("fuel").alias("Consumo_Combustible_Litros"),
    )
    return drawn.select(F.to_json(message).cast("binary").alias("body"))
