"""Column lists and types of every table in the lakehouse."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw fares keep the digits of the file; rounding happens once, on the total.
RAW_MONEY = T.DecimalType(14, 4)

# The thirteen source columns, in declared order.
SOURCE_FLIGHT = T.StructType(
    [
        T.StructField("ID_Vuelo", T.StringType()),
        T.StructField("Aerolinea", T.StringType()),
        T.StructField("Origen", T.StringType()),
        T.StructField("Destino", T.StringType()),
        T.StructField("Fecha_Programada", T.DateType()),
        T.StructField("Hora_Salida_UTC", T.StringType()),
        T.StructField("Distancia_KM", T.IntegerType()),
        T.StructField("Capacidad_Pasajeros", T.IntegerType()),
        T.StructField("Pasajeros_Reservados", T.IntegerType()),
        T.StructField("Clase_Tarifa", T.StringType()),
        T.StructField("Costo_Base", RAW_MONEY),
        T.StructField("Impuestos", RAW_MONEY),
        T.StructField("Tipo_Avion", T.StringType()),
    ]
)

# Source name -> bronze name.
BRONZE_NAMES = {
    "ID_Vuelo": "id_vuelo",
    "Aerolinea": "info_aerolinea",
    "Origen": "geo_origen",
    "Destino": "geo_destino",
    "Fecha_Programada": "fecha_programada",
    "Hora_Salida_UTC": "hora_salida_utc",
    "Distancia_KM": "op_distancia_km",
    "Capacidad_Pasajeros": "capacidad_pasajeros",
    "Pasajeros_Reservados": "op_pasajeros_reservados",
    "Clase_Tarifa": "tarifa_clase",
    "Costo_Base": "tarifa_costo_base",
    "Impuestos": "tarifa_impuestos",
    "Tipo_Avion": "op_tipo_avion",
}

# Source columns that must not be NULL; enforced only on request.
REQUIRED_SOURCE = ("ID_Vuelo", "Origen", "Destino")

# Column order of the historical CSV file.
CSV_ORDER = (
    "ID_Vuelo",
    "Aerolinea",
    "Origen",
    "Destino",
    "Fecha_Programada",
    "Hora_Salida_UTC",
    "Tipo_Avion",
    "Capacidad_Pasajeros",
    "Pasajeros_Reservados",
    "Distancia_KM",
    "Clase_Tarifa",
    "Costo_Base",
    "Impuestos",
)

# The eight fields of a tracking event.
TRACKING_EVENT = T.StructType(
    [
        T.StructField("ID_Vuelo", T.StringType()),
        T.StructField("Timestamp_Evento", T.TimestampType()),
        T.StructField("Estado_Actual", T.StringType()),
        T.StructField("Retraso_Minutos", T.IntegerType()),
        T.StructField("Puerta_Asignada", T.StringType()),
        T.StructField("Ruta_Evento", T.StringType()),
        T.StructField("Nivel_Servicio", T.IntegerType()),
        T.StructField("Consumo_Combustible_Litros", T.FloatType()),
    ]
)

# Event Hubs / Kafka style envelope around the event body.
EVENT_ENVELOPE = T.StructType(
    [
        T.StructField("body", T.BinaryType()),
        T.StructField("sequenceNumber", T.LongType()),
        T.StructField("enqueuedTime", T.TimestampType()),
        T.StructField("partition", T.StringType()),
    ]
)

# The columns silver adds, in order.
SILVER_ADDED = (
    "analisis_anio",
    "analisis_mes",
    "analisis_dia_semana",
    "tarifa_precio_total_ticket",
    "indicador_es_bajo_costo",
    "geo_id_ruta",
    "op_distancia_millas",
    "indicador_alta_capacidad",
)

# Grouping columns of the gold table, silver name -> gold name.
GOLD_DIMENSIONS = {
    "analisis_anio": "dim_anio",
    "analisis_mes": "dim_mes",
    "info_aerolinea": "dim_aerolinea",
    "geo_id_ruta": "dim_ruta_id",
}

# The gold table.
GOLD_FLIGHT = T.StructType(
    [
        T.StructField("dim_anio", T.IntegerType()),
        T.StructField("dim_mes", T.IntegerType()),
        T.StructField("dim_aerolinea", T.StringType()),
        T.StructField("dim_ruta_id", T.StringType()),
        T.StructField("gld_ingreso_total", T.DoubleType()),
        T.StructField("gld_vuelos_contados", T.LongType()),
        T.StructField("gld_pasajeros_totales", T.LongType()),
        T.StructField("gld_capacidad_total", T.LongType()),
        T.StructField("gld_vuelos_bajo_costo", T.LongType()),
        T.StructField("gld_load_factor_porc", T.DoubleType()),
        T.StructField("gld_precio_promedio_ticket", T.DoubleType()),
    ]
)

TRACKING_KEY = "tracking_key"

# What the joined tables carry of an event besides the key.
TRACKING_COLUMNS = (
    "tracking_timestamp_evento",
    "estado_actual_normalizado",
    "tracking_retraso_minutos",
    "indicador_retraso_alto",
    "tracking_puerta_asignada",
    "tracking_ruta_evento",
    "tracking_nivel_servicio",
    "tracking_consumo_combustible_litros",
)
