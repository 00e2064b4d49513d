import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from skyledger.config import Rules
from skyledger.operators import silver
from skyledger.operators.bronze import require_present, stamp_ingestion
from skyledger.schemas import BRONZE_NAMES, SILVER_ADDED
from tests.data import bronze, source


def first(df, *columns):
    return tuple(df.select(*columns).first())


def test_bronze_names_and_stamp(spark):
    df = stamp_ingestion(bronze(spark))
    assert df.columns == [*BRONZE_NAMES.values(), "ingestion_date"]
    assert dict(df.dtypes)["ingestion_date"] == "timestamp"
    assert df.first()["ingestion_date"] is not None


def test_silver_columns_in_order(spark):
    df = silver.silver_flights(bronze(spark))
    assert df.columns == [*BRONZE_NAMES.values(), *SILVER_ADDED]
    row = df.first()
    assert row["tarifa_precio_total_ticket"] == Decimal("380.65")
    assert row["geo_id_ruta"] == "SCL-MIA"
    assert row["op_distancia_millas"] == 4132.12
    assert row["indicador_es_bajo_costo"] is True
    assert row["indicador_alta_capacidad"] == 1


def test_silver_types(spark):
    types = dict(silver.silver_flights(bronze(spark)).dtypes)
    assert [types[name] for name in SILVER_ADDED] == [
        "int", "int", "int", "decimal(14,2)", "boolean", "string", "double", "int",
    ]


def test_totals_and_miles_agree_with_exact_arithmetic(spark):
    rnd = random.Random(11)
    cases = [
        (Decimal(rnd.randrange(10**8)) / 10**4, Decimal(rnd.randrange(10**7)) / 10**4, rnd.randrange(20_000))
        for _ in range(2000)
    ]
    df = bronze(
        spark, *({"Costo_Base": c, "Impuestos": t, "Distancia_KM": km} for c, t, km in cases)
    )
    got = df.transform(silver.add_ticket_total).transform(silver.add_miles)
    cent = Decimal("0.01")
    for row, (cost, tax, km) in zip(
        got.select("tarifa_precio_total_ticket", "op_distancia_millas").collect(), cases
    ):
        assert row[0] == (cost + tax).quantize(cent, ROUND_HALF_UP)
        assert row[1] == float((km * Decimal("0.621371")).quantize(cent, ROUND_HALF_UP))


def test_day_of_week_starts_on_sunday(spark):
    df = silver.add_calendar(bronze(spark, {"Fecha_Programada": dt.date(2025, 3, 9)}))
    assert first(df, "analisis_anio", "analisis_mes", "analisis_dia_semana") == (2025, 3, 1)


def test_total_rounds_half_up_after_adding(spark):
    df = silver.add_ticket_total(
        bronze(spark, {"Costo_Base": Decimal("100.0020"), "Impuestos": Decimal("0.0030")})
    )
    assert first(df, "tarifa_precio_total_ticket") == (Decimal("100.01"),)


def test_low_cost_limit_is_exclusive_and_unknown_is_not_low(spark):
    cases = [
        {"Costo_Base": Decimal("399.99"), "Impuestos": Decimal(0)},
        {"Costo_Base": Decimal("400.00"), "Impuestos": Decimal(0)},
        {"Costo_Base": None},
        {"Impuestos": None},
    ]
    df = bronze(spark, *cases).transform(silver.add_ticket_total).transform(silver.add_low_cost)
    assert [r[0] for r in df.select("indicador_es_bajo_costo").collect()] == [True, False, False, False]


def test_missing_values_pass_through(spark):
    df = silver.silver_flights(
        bronze(
            spark,
            {
                "Fecha_Programada": None,
                "Origen": None,
                "Costo_Base": None,
                "Distancia_KM": None,
                "Capacidad_Pasajeros": None,
            },
        )
    )
    assert first(df, *SILVER_ADDED) == (None, None, None, None, False, None, None, 0)


def test_capacity_limit_is_inclusive(spark):
    df = silver.add_high_capacity(
        bronze(spark, {"Capacidad_Pasajeros": 299}, {"Capacidad_Pasajeros": 300})
    )
    assert [r[0] for r in df.select("indicador_alta_capacidad").collect()] == [0, 1]


def test_rules_are_parameters(spark):
    rules = Rules(low_cost_limit=Decimal("100.00"), high_capacity_seats=500, miles_per_km=1.0)
    df = silver.silver_flights(bronze(spark), rules)
    assert first(
        df, "indicador_es_bajo_costo", "indicador_alta_capacidad", "op_distancia_millas"
    ) == (False, 0, 6650.0)


def test_required_fields_are_checked_on_request_only(spark):
    df = source(spark, {"ID_Vuelo": None}, {"Destino": None}, {"Aerolinea": None}, {})
    assert df.count() == 4
    assert require_present(df).count() == 2


def test_silver_has_no_shuffle(spark):
    plan = silver.silver_flights(bronze(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
