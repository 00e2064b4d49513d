"""Hand-made rows."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skyledger.operators.bronze import rename_flights
from skyledger.schemas import SOURCE_FLIGHT, TRACKING_EVENT

FLIGHT = {
    "ID_Vuelo": "AA100",
    "Aerolinea": "AirCorp",
    "Origen": "SCL",
    "Destino": "MIA",
    "Fecha_Programada": dt.date(2025, 3, 9),
    "Hora_Salida_UTC": "10:30",
    "Distancia_KM": 6650,
    "Capacidad_Pasajeros": 300,
    "Pasajeros_Reservados": 240,
    "Clase_Tarifa": "Económica",
    "Costo_Base": Decimal("310.55"),
    "Impuestos": Decimal("70.10"),
    "Tipo_Avion": "B787",
}

EVENT = {
    "ID_Vuelo": "AA100",
    "Timestamp_Evento": dt.datetime(2025, 3, 9, 12, 0),
    "Estado_Actual": "En Vuelo",
    "Retraso_Minutos": 0,
    "Puerta_Asignada": "A1",
    "Ruta_Evento": "SCL->MIA",
    "Nivel_Servicio": 1,
    "Consumo_Combustible_Litros": 5000.0,
}


def source(spark: SparkSession, *changes: dict) -> DataFrame:
    rows = [tuple({**FLIGHT, **c}[n] for n in SOURCE_FLIGHT.fieldNames()) for c in changes or ({},)]
    return spark.createDataFrame(rows, SOURCE_FLIGHT)


def bronze(spark: SparkSession, *changes: dict) -> DataFrame:
    return rename_flights(source(spark, *changes))


def events(spark: SparkSession, *changes: dict) -> DataFrame:
    rows = [tuple({**EVENT, **c}[n] for n in TRACKING_EVENT.fieldNames()) for c in changes or ({},)]
    return spark.createDataFrame(rows, TRACKING_EVENT)


def message(**changes) -> bytes:
    event = {**EVENT, **changes}
    if isinstance(event["Timestamp_Evento"], dt.datetime):
        event["Timestamp_Evento"] = event["Timestamp_Evento"].isoformat() + "Z"
    return json.dumps(event).encode()


def bodies(spark: SparkSession, *payloads: bytes | None) -> DataFrame:
    return spark.createDataFrame([(p,) for p in payloads], T.StructType().add("body", T.BinaryType()))


def rows(df: DataFrame) -> list[tuple]:
    """All rows in a comparable order, columns by name."""
    names = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
