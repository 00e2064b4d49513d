"""Joins of a history with few states that are not broadcast, and the current rows of its batches."""

import pytest
from pyspark.sql import functions as F

from skyledger.operators import enrich, sieve
from skyledger.operators import tracking as tk
from skyledger.operators.silver import silver_flights
from skyledger.sources import tables
from skyledger.streaming import jobs
from tests.data import bodies, bronze, events, message, rows
from tests.test_streaming import FILES, all_events


@pytest.fixture
def few(conf, monkeypatch):
    """States count as few beside any history, and as too large to broadcast."""
    monkeypatch.setattr(sieve, "TIMES", 0)
    conf(spark__sql__autoBroadcastJoinThreshold="10")


@pytest.fixture
def sides(spark, tmp_path):
    flights = [{"ID_Vuelo": f"AA{n % 150}", "Distancia_KM": n} for n in range(200)]
    flights += [{"ID_Vuelo": None, "Distancia_KM": n} for n in range(20)]
    path = str(tmp_path / "silver")
    silver_flights(bronze(spark, *flights)).write.parquet(path)
    latest = tk.latest_state(events(spark, *({"ID_Vuelo": i} for i in ("AA3", "AA3", "AA140", "NEW"))))
    return spark.read.parquet(path), tables.settle(latest, str(tmp_path / "latest"))


@pytest.mark.parametrize("combine", [
    enrich.flights_with_state, enrich.touched_flights, enrich.active_with_history, enrich.flights_without,
])
@pytest.mark.parametrize("cells", [1, 7, sieve.CELLS])
def test_sifting_never_changes_the_result(sides, few, monkeypatch, combine, cells):
    history, latest = sides
    monkeypatch.setattr(sieve, "CELLS", cells)
    sifted = combine(history, latest)
    monkeypatch.setattr(sieve, "TIMES", 1 << 60)
    whole = combine(history, latest)
    assert sifted.columns == whole.columns and rows(sifted) == rows(whole)


def test_flights_that_no_state_can_match_are_not_shuffled(sides, few):
    history, latest = sides
    asked, rest = enrich.sifted(history, latest)
    assert rows(asked.unionByName(rest)) == rows(history)
    assert asked.where("id_vuelo in ('AA3', 'AA140')").count() == asked.count() == 3
    text = enrich.flights_with_state(history, latest)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text and "LeftSemi" in text and "SortMergeJoin" in text


def test_a_session_without_broadcasts_gets_none(sides, few, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert enrich.sifted(*sides)[1] is None


@pytest.fixture
def history(spark, lake):
    name = lake.table_name("silver")
    flights = [{"ID_Vuelo": f"AA{n}"} for n in (1, 1, 2, 3, 4, 5)] + [{"ID_Vuelo": None}] * 2
    tables.overwrite_table(silver_flights(bronze(spark, *flights)), name)
    return name


@pytest.mark.parametrize("side", ["history", "active"])
@pytest.mark.parametrize("times", [0, 1 << 60])
def test_current_rows_are_those_of_all_events(spark, lake, tmp_path, history, few, monkeypatch, side, times):
    monkeypatch.setattr(sieve, "TIMES", times)
    name = lake.table_name("gold", stream=True)
    write = jobs.gold_batch_writer(history, name, str(tmp_path / "staging"), side=side)
    for batch_id, payloads in enumerate((*FILES, (message(ID_Vuelo="AA4"),))):
        write(tk.parse_events(bodies(spark, *payloads)), batch_id)
    seen = all_events(spark).unionByName(tk.parse_events(bodies(spark, message(ID_Vuelo="AA4"))))
    expected = jobs.SIDES[side](spark.table(history), tk.latest_state(seen))
    current = jobs.read_gold(spark, name)
    assert current.columns == expected.columns and rows(current) == rows(expected)


def test_flights_without_an_event_are_read_from_one_batch_and_not_shuffled(spark, lake, tmp_path, history, few):
    name = lake.table_name("gold", stream=True)
    write = jobs.gold_batch_writer(history, name, str(tmp_path / "staging"))
    for batch_id, flight in enumerate(("AA1", "AA2")):
        write(tk.parse_events(bodies(spark, message(ID_Vuelo=flight))), batch_id)
    text = jobs.read_gold(spark, name)._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in text.splitlines() if "Aggregate [" in line and "max(struct" in line]
    below = text[text.index(grouped[0]):].splitlines()[1:5]
    assert grouped and any("isnotnull(tracking_timestamp_evento" in line for line in below)


@pytest.mark.parametrize("times", [0, 1 << 60])
def test_the_states_tell_which_batch_is_current(spark, lake, tmp_path, history, few, monkeypatch, times):
    """Rows of all batches are read for the result once, besides those of the last batch; where
    a batch's states are not kept, its rows tell the same."""
    monkeypatch.setattr(sieve, "TIMES", times)
    name = lake.table_name("gold", stream=True)
    write = jobs.gold_batch_writer(history, name, str(tmp_path / "staging"))
    for batch_id, flight in enumerate(("AA1", "AA2", "AA1", "NEW")):
        write(tk.parse_events(bodies(spark, message(ID_Vuelo=flight))), batch_id)
    current = jobs.read_gold(spark, name)
    text = current._jdf.queryExecution().optimizedPlan().toString()
    assert text.count(f"Relation spark_catalog.{name}[") == (3 if times == 0 else 2)
    told = rows(current)
    tables.drop_batches(spark, jobs.states_table(name), [1])
    assert rows(jobs.read_gold(spark, name)) == told
    spark.sql(f"DROP TABLE {jobs.states_table(name)}")
    assert rows(jobs.read_gold(spark, name)) == told and len(told) == 8


def test_batches_of_unnamed_loads_may_hold_different_flights(spark, lake, tmp_path, history):
    """As a history without versions leaves them: a flight that only an older batch has stays."""
    name, other = lake.table_name("gold", stream=True), lake.table_name("gold", stream=True, table="sin_version")
    write = jobs.gold_batch_writer(history, name, str(tmp_path / "staging"))
    write(tk.parse_events(bodies(spark, message(ID_Vuelo="AA1"))), 0)
    batch = spark.table(name).drop(tables.BATCH_ID).withColumn(jobs.HISTORY_VERSION, F.lit(""))
    tables.write_batch(batch, other, 0)
    tables.write_batch(batch.where("id_vuelo <> 'AA5'"), other, 1)
    assert jobs.read_gold(spark, other).where("id_vuelo = 'AA5'").count() == 1
