import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Observation

from skyledger.schemas import CSV_ORDER, SOURCE_FLIGHT
from skyledger.sources import csv_files
from tests.data import FLIGHT, rows, source

LINE = "AA100,AirCorp,SCL,MIA,2025-03-09,10:30,B787,300,240,6650,Económica,310.55,70.10"


def csv(folder, name, *lines, header=",".join(CSV_ORDER)):
    path = folder / name
    path.mkdir(exist_ok=True)
    (path / f"part-{len(list(path.iterdir()))}.csv").write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_columns_are_matched_by_name(spark, tmp_path):
    row = csv_files.read_flights(spark, csv(tmp_path, "a", LINE)).first()
    assert row.asDict() == {**FLIGHT, "Costo_Base": Decimal("310.5500"), "Impuestos": Decimal("70.1000")}


def test_declared_types(spark, tmp_path):
    df = csv_files.read_flights(spark, csv(tmp_path, "a", LINE))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SOURCE_FLIGHT]


def test_unreadable_cells_become_null_and_are_counted(spark, tmp_path):
    bad = LINE.replace("6650", "lejos").replace("2025-03-09", "mañana").replace("310.55", "gratis")
    path = csv(tmp_path, "a", LINE, bad, LINE.replace("6650", ""))
    seen = Observation()
    df = csv_files.read_flights(spark, path, bad_cells=seen)
    values = [(r.Distancia_KM, r.Fecha_Programada, r.Costo_Base) for r in df.collect()]
    good = (6650, dt.date(2025, 3, 9), Decimal("310.5500"))
    assert values == [good, (None, None, None), (None, *good[1:])]
    expected = {
        "Fecha_Programada": 1,
        "Distancia_KM": 1,
        "Capacidad_Pasajeros": 0,
        "Pasajeros_Reservados": 0,
        "Costo_Base": 1,
        "Impuestos": 0,
    }
    assert seen.get == expected
    assert {r[0]: r[1] for r in csv_files.bad_cell_report(spark, path).collect()} == expected


def test_another_header_in_the_same_folder_stops_the_load(spark, tmp_path):
    csv(tmp_path, "a", LINE)
    reordered = ",".join(reversed(CSV_ORDER))
    path = csv(tmp_path, "a", ",".join(reversed(LINE.split(","))), header=reordered)
    with pytest.raises(Exception, match="(?i)header"):
        csv_files.read_flights(spark, path).collect()


def test_locations_with_different_orders(spark, tmp_path):
    a = csv(tmp_path, "a", LINE)
    b = csv(
        tmp_path,
        "b",
        ",".join(reversed(LINE.split(","))),
        header=",".join(reversed(CSV_ORDER)),
    )
    found = rows(csv_files.read_flights(spark, a, b))
    assert len(found) == 2 and found[0] == found[1]
    with pytest.raises(ValueError):
        csv_files.read_flights(spark, a, b, bad_cells=Observation())
    with pytest.raises(ValueError):
        csv_files.read_flights(spark)


def test_time_of_day_stays_text(spark, tmp_path):
    path = csv(tmp_path, "a", LINE)
    assert dict(csv_files.read_flights(spark, path).dtypes)["Hora_Salida_UTC"] == "string"
    guessed = csv_files.infer_schema(spark, path)
    assert guessed["Hora_Salida_UTC"].dataType.simpleString() == "timestamp"


def test_written_files_read_back(spark, tmp_path):
    flights = source(spark, {}, {"ID_Vuelo": "LA200", "Destino": None}, {"Costo_Base": None})
    path = str(tmp_path / "out")
    csv_files.write_flights(flights, path)
    assert rows(csv_files.read_flights(spark, path)) == rows(flights)
