"""Silver flights to the monthly result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import flights as fl
from skyledger.schemas import GOLD_DIMENSIONS, GOLD_FLIGHT


def _revenue() -> Column:
    """Sum of the ticket totals, added up as decimals, as double. Exact in any order;
    the sum has ten digits more than a ticket, so no real input reaches its bound."""
    return F.sum(F.col("tarifa_precio_total_ticket").cast("decimal(14,2)")).cast("double")


def monthly_by_route(silver: DataFrame) -> DataFrame:
    """Revenue, flights, passengers, capacity and ratios per year, month,
    airline and route.

    One shuffle, of partial sums: a task sends at most one row per group, so a
    group that holds a third of the input still arrives as a few rows.
    ``gld_precio_promedio_ticket`` is revenue (one ticket per flight) over
    passengers; the name is the data model's.
    """
    totals = silver.groupBy(
        *(F.col(old).alias(new) for old, new in GOLD_DIMENSIONS.items())
    ).agg(
        _revenue().alias("gld_ingreso_total"),
        F.count("id_vuelo").alias("gld_vuelos_contados"),
        F.sum("op_pasajeros_reservados").alias("gld_pasajeros_totales"),
        F.sum("capacidad_pasajeros").alias("gld_capacidad_total"),
        F.count_if("indicador_es_bajo_costo").alias("gld_vuelos_bajo_costo"),
    )
    return _with_ratios(totals).select(*GOLD_FLIGHT.fieldNames())


#: Column that a month's results are stored by: year and month as one number, 0 if unknown.
PERIOD = "periodo"


def partial_sums(silver: DataFrame) -> DataFrame:
    """What both monthly results need of some flights, per year, month, airline and route.
    Sums of several loads add up to the sums of all their flights."""
    load = _load_factor()
    period = F.coalesce(F.col("analisis_anio") * 100 + F.col("analisis_mes"), F.lit(0))
    return silver.groupBy(
        period.alias(PERIOD), *(F.col(old).alias(new) for old, new in GOLD_DIMENSIONS.items())
    ).agg(
        F.sum(F.col("tarifa_precio_total_ticket").cast("decimal(14,2)")).alias("ingreso"),
        F.count("id_vuelo").alias("vuelos"),
        F.sum("op_pasajeros_reservados").alias("pasajeros"),
        F.sum("capacidad_pasajeros").alias("capacidad"),
        F.count_if("indicador_es_bajo_costo").alias("bajo_costo"),
        F.sum(load).alias("carga"),
        F.count(load).alias("con_carga"),
    )


def monthly_from_partials(partials: DataFrame) -> DataFrame:
    """``monthly_by_route`` of all flights that the partial sums stand for, with ``PERIOD``."""
    totals = partials.groupBy(PERIOD, *GOLD_DIMENSIONS.values()).agg(
        F.sum("ingreso").cast("double").alias("gld_ingreso_total"),
        F.sum("vuelos").alias("gld_vuelos_contados"),
        F.sum("pasajeros").alias("gld_pasajeros_totales"),
        F.sum("capacidad").alias("gld_capacidad_total"),
        F.sum("bajo_costo").alias("gld_vuelos_bajo_costo"),
    )
    return _with_ratios(totals).select(*GOLD_FLIGHT.fieldNames(), PERIOD)


def airlines_from_partials(partials: DataFrame) -> DataFrame:
    """``monthly_by_airline`` of all flights that the partial sums stand for."""
    load = F.try_divide(F.sum("carga"), F.sum("con_carga"))
    return partials.groupBy(PERIOD, "dim_aerolinea", "dim_anio", "dim_mes").agg(
        F.sum("ingreso").cast("double").alias("ingreso_total"),
        F.round(load, 6).alias("load_factor_promedio"),
    )


def _load_factor() -> Column:
    return F.try_divide(
        F.col("op_pasajeros_reservados").cast("double"),
        F.col("capacidad_pasajeros").cast("double"),
    )


def _with_ratios(totals: DataFrame) -> DataFrame:
    people, seats = F.col("gld_pasajeros_totales"), F.col("gld_capacidad_total")
    return totals.select(
        "*",
        fl.percent(people, seats).alias("gld_load_factor_porc"),
        fl.per_unit(F.col("gld_ingreso_total"), people).alias("gld_precio_promedio_ticket"),
    )


def monthly_by_airline(silver: DataFrame) -> DataFrame:
    """Revenue and mean load factor per airline, year and month.

    The load factor of a flight is passengers over capacity; a flight whose
    capacity is unknown or zero has none and stays out of the mean.
    """
    load = _load_factor()
    return silver.groupBy(
        F.col("info_aerolinea").alias("dim_aerolinea"),
        F.col("analisis_anio").alias("dim_anio"),
        F.col("analisis_mes").alias("dim_mes"),
    ).agg(
        _revenue().alias("ingreso_total"),
        F.round(F.avg(load), 6).alias("load_factor_promedio"),
    )
