from decimal import Decimal

from pyspark.sql import functions as F

from skyledger.operators.gold import monthly_by_airline, monthly_by_route
from skyledger.operators.silver import silver_flights
from skyledger.schemas import GOLD_FLIGHT
from skyledger.sources import generators
from skyledger.operators.bronze import rename_flights
from tests.data import bronze


def gold(spark, *changes):
    return monthly_by_route(silver_flights(bronze(spark, *changes)))


def test_schema(spark):
    df = gold(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in GOLD_FLIGHT]


def test_sums_counts_and_ratios(spark):
    row = gold(
        spark,
        {"Costo_Base": Decimal("10.55"), "Impuestos": Decimal(0), "Pasajeros_Reservados": 1},
        {"Costo_Base": None, "Pasajeros_Reservados": 2, "Capacidad_Pasajeros": 100},
        {"ID_Vuelo": None, "Costo_Base": None, "Pasajeros_Reservados": None, "Capacidad_Pasajeros": None},
    ).first()
    assert row.gld_ingreso_total == 10.55
    assert row.gld_vuelos_contados == 2
    assert (row.gld_pasajeros_totales, row.gld_capacidad_total) == (3, 400)
    assert row.gld_vuelos_bajo_costo == 1
    assert row.gld_load_factor_porc == 0.75
    assert row.gld_precio_promedio_ticket == 3.52


def test_zero_capacity_and_passengers_give_zero(spark):
    row = gold(spark, {"Capacidad_Pasajeros": 0, "Pasajeros_Reservados": 0}).first()
    assert (row.gld_load_factor_porc, row.gld_precio_promedio_ticket) == (0.0, 0.0)


def test_all_unknown(spark):
    row = gold(
        spark, {"Costo_Base": None, "Capacidad_Pasajeros": None, "Pasajeros_Reservados": None}
    ).first()
    assert (row.gld_ingreso_total, row.gld_pasajeros_totales, row.gld_capacidad_total) == (None,) * 3
    assert (row.gld_vuelos_bajo_costo, row.gld_load_factor_porc, row.gld_precio_promedio_ticket) == (0, 0, 0)


def test_unknown_route_is_a_group(spark):
    routes = {r.dim_ruta_id: r.gld_vuelos_contados for r in gold(spark, {}, {"Destino": None}, {"Origen": None}).collect()}
    assert routes == {"SCL-MIA": 1, None: 2}


def test_revenue_is_exact_beyond_double_precision(spark):
    big = {"Costo_Base": Decimal("9999999999.99"), "Impuestos": Decimal("0.00")}
    row = gold(spark, *[big] * 1000).first()
    assert row.gld_ingreso_total == float(Decimal("9999999999.99") * 1000)


def test_revenue_has_no_64_bit_bound(spark, conf):
    conf(spark__sql__ansi__enabled="false")
    ticket = F.lit(Decimal("999999999999.00")).cast("decimal(14,2)")
    silver = silver_flights(bronze(spark, {})).withColumn("tarifa_precio_total_ticket", ticket)
    row = monthly_by_route(silver.crossJoin(spark.range(200_000)).drop("id")).first()
    assert row.gld_ingreso_total == 199999999999800000.0


def test_group_totals_equal_overall_totals(spark):
    silver = silver_flights(rename_flights(generators.generate_flights(spark, 3000)))
    by_group = monthly_by_route(silver).agg(
        F.sum("gld_vuelos_contados"),
        F.sum("gld_pasajeros_totales"),
        F.sum("gld_vuelos_bajo_costo"),
        F.round(F.sum("gld_ingreso_total"), 2),
    )
    overall = silver.agg(
        F.count("id_vuelo"),
        F.sum("op_pasajeros_reservados"),
        F.count_if("indicador_es_bajo_costo"),
        F.sum("tarifa_precio_total_ticket").cast("double"),
    )
    assert tuple(by_group.first()) == tuple(overall.first())


def test_airline_month_skips_flights_without_load_factor(spark):
    row = monthly_by_airline(
        silver_flights(
            bronze(
                spark,
                {"Pasajeros_Reservados": 150},
                {"Pasajeros_Reservados": 300},
                {"Capacidad_Pasajeros": 0},
                {"Capacidad_Pasajeros": None},
            )
        )
    ).first()
    assert (row.ingreso_total, row.load_factor_promedio) == (1522.6, 0.75)
