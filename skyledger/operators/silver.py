"""Bronze flights to silver flights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.config import Rules
from skyledger.functions import flights as fl


def add_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(fl.calendar_parts(F.col("fecha_programada")))


def add_ticket_total(df: DataFrame) -> DataFrame:
    total = fl.ticket_total(F.col("tarifa_costo_base"), F.col("tarifa_impuestos"))
    return df.withColumn("tarifa_precio_total_ticket", total)


def add_low_cost(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    flag = fl.is_low_cost(F.col("tarifa_precio_total_ticket"), rules.low_cost_limit)
    return df.withColumn("indicador_es_bajo_costo", flag)


def add_route(df: DataFrame) -> DataFrame:
    return df.withColumn("geo_id_ruta", fl.route_key(F.col("geo_origen"), F.col("geo_destino")))


def add_miles(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    miles = fl.km_to_miles(F.col("op_distancia_km"), rules.miles_per_km)
    return df.withColumn("op_distancia_millas", miles)


def add_high_capacity(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    flag = fl.high_capacity_flag(F.col("capacidad_pasajeros"), rules.high_capacity_seats)
    return df.withColumn("indicador_alta_capacidad", flag)


def silver_flights(bronze: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """All eight derived columns. Row-wise throughout, so the step is one scan
    and one projection with no shuffle."""
    return (
        bronze.transform(add_calendar)
        .transform(add_ticket_total)
        .transform(add_low_cost, rules)
        .transform(add_route)
        .transform(add_miles, rules)
        .transform(add_high_capacity, rules)
    )
