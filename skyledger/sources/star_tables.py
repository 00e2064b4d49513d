"""Flights and tracking events out of the supplied star-schema tables.

Line items play scheduled flights and user events play tracking events. Every
input row gives exactly one output row; the conditions on numbers below only
decide which rows carry a missing or damaged field, so that the rules for such
rows have something to act on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.bronze import rename_flights
from skyledger.schemas import SOURCE_FLIGHT
from skyledger.sources.generators import AIRLINES, AIRPORTS, FARE_CLASSES, PLANES, pick


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def source_flights(lineitem: DataFrame) -> DataFrame:
    """Line items under the thirteen source columns.

    Tax is unknown where it is zero, the destination on seventh lines, the
    capacity on sixth lines of returned items; the order key is not unique.
    """
    part, supplier, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    cents = F.lit(0.01).cast("decimal(3,2)")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    tax = F.nullif(F.col("l_tax"), F.lit(0.0)).cast("decimal(4,2)")
    plane = pick(list(PLANES), part)
    seats = pick(list(PLANES.values()), part)
    known_seats = F.when((line == 6) & (F.col("l_returnflag") == "R"), None).otherwise(seats)
    columns = {
        "ID_Vuelo": F.concat(F.lit("AA"), F.col("l_orderkey").cast("string")),
        "Aerolinea": pick(AIRLINES, supplier),
        "Origen": pick(AIRPORTS, part),
        "Destino": F.when(line != 7, pick(AIRPORTS, part + 1 + supplier % 7)),
        "Fecha_Programada": F.col("l_shipdate").cast("date"),
        "Hora_Salida_UTC": F.concat(F.lpad((line + 6).cast("string"), 2, "0"), F.lit(":30")),
        "Distancia_KM": (part + 500).cast("int"),
        "Capacidad_Pasajeros": known_seats,
        "Pasajeros_Reservados": F.floor(seats * F.col("l_quantity").cast("int") / 50).cast("int"),
        "Clase_Tarifa": pick(FARE_CLASSES, line),
        "Costo_Base": price * cents,
        "Impuestos": F.round(price * tax * cents, 4),
        "Tipo_Avion": plane,
    }
    return lineitem.select(
        *(columns[f.name].cast(f.dataType).alias(f.name) for f in SOURCE_FLIGHT)
    )


def bronze_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").transform(source_flights).transform(rename_flights)


def csv_text(flights: DataFrame) -> DataFrame:
    """Flights as they stand in a file: text, with an unreadable distance on
    economy flights of 200 km steps."""
    unreadable = (F.col("Clase_Tarifa") == FARE_CLASSES[0]) & _every("Distancia_KM", 200)
    cells = {c: F.col(c).cast("string") for c in flights.columns}
    cells["Distancia_KM"] = F.when(unreadable, "n/d").otherwise(cells["Distancia_KM"])
    return flights.select(*(cell.alias(name) for name, cell in cells.items()))


def event_bodies(events: DataFrame) -> DataFrame:
    """User events as JSON messages in the event envelope.

    A few rows get a corrupt, blank or missing id, no time, no delay, or a body
    that is not JSON; states vary in case and surrounding spaces.
    """
    kind = F.col("event_type")
    late, cancelled = kind == "error", kind == "signup"
    flight = F.concat(F.lit("AA"), F.col("user_id").cast("string"))
    state = (
        F.when(late, "Retrasado")
        .when(cancelled, "Cancelado")
        .when(kind == "click", "En Vuelo")
        .when(kind == "view", "Aterrizado")
        .otherwise("Puerta Asignada")
    )
    delay = (
        F.when(late & _every("event_id", 7), None)
        .when(late, F.floor(F.col("value")).cast("int") - 5)
        .when(cancelled, 999)
        .otherwise(0)
    )
    gate = F.concat(
        pick(["A", "B", "C"], F.col("event_id")), (F.col("user_id") % 20 + 1).cast("string")
    )
    message = F.struct(
        F.when(_every("event_id", 59), None)
        .when(_every("event_id", 53), "   ")
        .when(_every("event_id", 50), F.concat(flight, F.lit("_ERR")))
        .otherwise(flight)
        .alias("ID_Vuelo"),
        F.when(
            ~_every("event_id", 61), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        ).alias("Timestamp_Evento"),
        F.when(_every("event_id", 2), F.concat(F.lit(" "), state, F.lit("  ")))
        .when(_every("event_id", 3), F.lower(state))
        .otherwise(state)
        .alias("Estado_Actual"),
        delay.alias("Retraso_Minutos"),
        gate.alias("Puerta_Asignada"),
        F.lit("SCL->MIA").alias("Ruta_Evento"),
        F.when(late, F.col("event_id") % 2 + 2)
        .when(cancelled, 3)
        .otherwise(1)
        .alias("Nivel_Servicio"),
        (F.col("value") + 5000).cast("float").alias("Consumo_Combustible_Litros"),
    )
    text = F.when(_every("event_id", 71), "not json").otherwise(F.to_json(message))
    return events.select(
        text.cast("binary").alias("body"),
        F.col("event_id").alias("sequenceNumber"),
        F.col("ts").cast("timestamp").alias("enqueuedTime"),
        (F.col("user_id") % 4).cast("string").alias("partition"),
    )
