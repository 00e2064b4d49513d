import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skyledger.config import Rules
from skyledger.operators import tracking as tk
from skyledger.schemas import TRACKING_COLUMNS, TRACKING_EVENT, TRACKING_KEY
from tests.data import EVENT, bodies, events, message, rows

T0 = dt.datetime(2025, 3, 9, 12, 0)


def parsed(spark, *payloads):
    return [r.asDict() for r in tk.parse_events(bodies(spark, *payloads)).collect()]


NOTHING = dict.fromkeys(TRACKING_EVENT.fieldNames())


def test_parse_all_fields(spark):
    assert parsed(spark, message()) == [EVENT]


@pytest.mark.parametrize("payload", [None, b"", b"not json", b"[1]", b"{}"])
def test_unreadable_body_gives_a_row_of_nulls(spark, payload):
    assert parsed(spark, payload) == [NOTHING]


def test_wrong_type_loses_that_field_only(spark):
    for value in ("oops", 12.7):
        assert parsed(spark, message(Retraso_Minutos=value)) == [{**EVENT, "Retraso_Minutos": None}]


def test_number_for_a_text_field_becomes_text(spark):
    assert parsed(spark, message(ID_Vuelo=7))[0]["ID_Vuelo"] == "7"


def test_field_names_are_case_sensitive(spark):
    assert parsed(spark, b'{"id_vuelo": "AA1", "Nivel_Servicio": 2}') == [{**NOTHING, "Nivel_Servicio": 2}]


def test_times_with_and_without_fraction(spark):
    got = parsed(
        spark,
        message(Timestamp_Evento="2025-03-09T12:00:00Z"),
        message(Timestamp_Evento="2025-03-09T12:00:00.000250Z"),
    )
    assert [r["Timestamp_Evento"] for r in got] == [T0, T0.replace(microsecond=250)]


def test_unreadable_events_keep_every_input_column(spark):
    raw = bodies(spark, message(), b"not json", None).withColumn("n", F.monotonically_increasing_id() * 0 + 5)
    bad = tk.unreadable_events(raw)
    assert bad.columns == ["body", "n"]
    assert sorted((r.body or b"").decode() for r in bad.collect()) == ["", "not json"]


def test_clean_keeps_usable_ids_with_a_time(spark):
    ids = ["AA1", None, "", "   ", "AA2_ERR", "_ERR", "AAXERR", "\t"]
    df = tk.clean_events(events(spark, *({"ID_Vuelo": i} for i in ids), {"Timestamp_Evento": None}))
    assert sorted(r.ID_Vuelo for r in df.collect()) == ["\t", "AA1", "AAXERR"]


def test_state_delay_and_flag(spark):
    cases = [
        ("Retrasado", 30, "RETRASADO", 30, False),
        (" retrasado ", None, "RETRASADO", 15, False),
        ("RETRASADO", 0, "RETRASADO", 15, False),
        ("Retrasado", -4, "RETRASADO", 15, False),
        ("Retrasado", 60, "RETRASADO", 60, True),
        ("Cancelado", 999, "CANCELADO", 999, True),
        ("En Vuelo", None, "EN VUELO", None, False),
        ("En Vuelo", -4, "EN VUELO", -4, False),
        (None, None, None, None, False),
        ("demoró", 59, "DEMORÓ", 59, False),
    ]
    df = tk.add_state_columns(
        events(spark, *({"Estado_Actual": s, "Retraso_Minutos": d} for s, d, *_ in cases))
    )
    got = df.select("estado_actual_normalizado", "tracking_retraso_minutos", "indicador_retraso_alto")
    assert [tuple(r) for r in got.collect()] == [tuple(c[2:]) for c in cases]


def test_limits_are_parameters(spark):
    rules = Rules(min_delay=20, high_delay=20)
    row = tk.add_state_columns(events(spark, {"Estado_Actual": "Retrasado"}), rules).first()
    assert (row.tracking_retraso_minutos, row.indicador_retraso_alto) == (20, True)


def test_tracking_view_columns(spark):
    assert tk.latest_state(events(spark)).columns == [TRACKING_KEY, *TRACKING_COLUMNS]


@pytest.mark.parametrize("pick", [tk.latest_per_key, tk.latest_by_max])
def test_ties_in_time_go_by_the_other_fields(spark, pick):
    df = events(
        spark,
        {"Estado_Actual": "Aterrizado"},
        {"Estado_Actual": "En Vuelo", "Retraso_Minutos": None},
        {"Estado_Actual": "En Vuelo", "Retraso_Minutos": 3},
        {"Estado_Actual": None},
        {"Timestamp_Evento": T0 - dt.timedelta(seconds=1), "Estado_Actual": "Retrasado"},
    )
    (row,) = pick(df).collect()
    assert (row.Estado_Actual, row.Retraso_Minutos) == ("En Vuelo", 3)


def test_both_ways_to_pick_agree_on_random_events(spark):
    rnd = random.Random(7)
    df = events(
        spark,
        *(
            {
                "ID_Vuelo": rnd.choice(["AA1", "AA2", "AA3", "AA4"]),
                "Timestamp_Evento": T0 + dt.timedelta(seconds=rnd.randrange(4)),
                "Estado_Actual": rnd.choice([None, "x", "y"]),
                "Retraso_Minutos": rnd.choice([None, -1, 0, 5]),
                "Consumo_Combustible_Litros": rnd.choice([None, 1.5, float("nan"), -0.5]),
            }
            for _ in range(400)
        ),
    ).repartition(7)
    assert str(rows(tk.latest_per_key(df))) == str(rows(tk.latest_by_max(df)))
    assert tk.latest_by_max(df).count() == 4


def test_named_tie_break(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 1, 6, "y")], "k string, t int, n int, v string")
    assert tk.latest_per_key(df, "k", "t", ["n"]).first().v == "y"
