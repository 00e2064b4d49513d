from pyspark.sql import functions as F

from skyledger.operators import tracking as tk
from skyledger.schemas import CSV_ORDER
from skyledger.sources import generators as g
from tests.data import rows

N = 4000


def test_flights_are_repeatable_whatever_the_partitioning(spark):
    a = g.generate_flights(spark, 500, seed=3)
    b = g.flights_for(spark.range(500).repartition(9), "id", seed=3)
    assert rows(a) == rows(b)
    assert rows(a) != rows(g.generate_flights(spark, 500, seed=4))


def test_flights_stay_in_their_domains(spark):
    df = g.generate_flights(spark, N)
    assert df.columns == list(CSV_ORDER) and df.count() == N
    long_haul = F.col("Tipo_Avion").isin(*g.LONG_HAUL)
    km = F.col("Distancia_KM")
    fares = F.lit(False)
    for name, (cost, tax) in g.FARES.items():
        fares |= (
            (F.col("Clase_Tarifa") == name)
            & F.col("Costo_Base").between(*cost)
            & F.col("Impuestos").between(*tax)
        )
    checks = [
        F.col("ID_Vuelo").rlike("^(AA|LA|IB|DL)[1-9][0-9]{2,3}$"),
        F.col("Origen") != F.col("Destino"),
        F.col("Origen").isin(*g.AIRPORTS) & F.col("Destino").isin(*g.AIRPORTS),
        F.col("Fecha_Programada").between("2025-01-01", "2026-01-01"),
        F.col("Hora_Salida_UTC").rlike("^([01][0-9]|2[0-3]):(00|30)$"),
        F.expr("Capacidad_Pasajeros = map('B787',300,'A320',180,'B737',210,'A380',550)[Tipo_Avion]"),
        F.expr("Pasajeros_Reservados between floor(Capacidad_Pasajeros * 0.6) and Capacidad_Pasajeros"),
        F.when(long_haul, km.between(2000, 10000)).otherwise(km.between(500, 4500)),
        fares,
    ]
    assert df.select(*(F.count_if(~F.coalesce(c, F.lit(False))) for c in checks)).first() == (0,) * len(checks)


def test_every_value_is_drawn_about_equally(spark):
    df = g.generate_flights(spark, N)
    for column, size in [("Aerolinea", 4), ("Origen", 8), ("Destino", 8), ("Tipo_Avion", 4), ("Clase_Tarifa", 3)]:
        counts = [r["count"] for r in df.groupBy(column).count().collect()]
        assert len(counts) == size and min(counts) > 0.8 * N / size


def test_events_follow_the_rules_of_their_state(spark):
    flights = g.generate_flights(spark, N)
    events = tk.parse_events(g.events_for(flights)).cache()
    n = events.count()
    assert 1.8 * N < n < 2.2 * N
    assert events.join(flights, "ID_Vuelo", "left_anti").count() == 0
    rule = F.expr(
        """case Estado_Actual
             when 'Retrasado' then Retraso_Minutos between 15 and 180 and Nivel_Servicio in (2, 3)
             when 'Cancelado' then Retraso_Minutos = 999 and Nivel_Servicio = 3
             else Retraso_Minutos = 0 and Nivel_Servicio = 1 end
           and Puerta_Asignada rlike '^[ABC]([1-9]|1[0-9]|20)$' and Ruta_Evento = 'SCL->MIA'
           and Consumo_Combustible_Litros between 5000 and 30000 and Timestamp_Evento is not null"""
    )
    assert events.where(~F.coalesce(rule, F.lit(False))).count() == 0
    assert events.select("Estado_Actual").distinct().count() == 5
    assert tk.clean_events(events).count() == n


def test_damaged_events_are_a_share_of_all(spark):
    events = tk.parse_events(g.events_for(g.generate_flights(spark, N), damaged_per_mille=100))
    n = events.count()
    dropped = n - tk.clean_events(events).count()
    assert 0.05 * n < dropped < 0.1 * n
    assert events.where("Estado_Actual = 'Retrasado' and Retraso_Minutos = 0").count() > 0


def test_a_number_of_events_of_known_flights(spark):
    flights = g.generate_flights(spark, 300)
    events = tk.parse_events(g.generate_events(spark, 3000, flights, heavy_per_mille=300)).cache()
    assert events.count() == 3000
    assert events.join(flights, "ID_Vuelo", "left_anti").count() == 0
    counts = sorted(r["count"] for r in events.groupBy("ID_Vuelo").count().collect())
    assert 800 < counts[-1] < 1000 and counts[-2] < 40 and len(counts) > 250
    assert g.generate_events(spark, 50, flights.where("false")).count() == 0


def test_numbers_have_no_gaps(spark):
    values = spark.range(5000).selectExpr("if(id % 9 = 0, null, concat('k', id % 3000)) as k")
    numbers, size = g.numbered(values, "k")
    found = [r.number for r in numbers.collect()]
    assert sorted(found) == list(range(size)) and size == values.where("k is not null").distinct().count()
