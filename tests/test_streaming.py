import datetime as dt
import itertools
import os
import shutil
from pathlib import Path

import pytest

from skyledger.config import Horizon
from skyledger.operators import buckets, enrich
from skyledger.operators import tracking as tk
from skyledger.operators.silver import silver_flights
from skyledger.schemas import EVENT_ENVELOPE, TRACKING_EVENT
from skyledger.session import stream_session
from skyledger.sources import streams, tables
from skyledger.streaming import jobs
from tests.data import bodies, bronze, message, rows

T0 = dt.datetime(2025, 3, 9, 12, 0)


def at(minute):
    return T0 + dt.timedelta(minutes=minute)


# Three files; later files hold older events of the same flights.
FILES = [
    [message(ID_Vuelo="AA1", Timestamp_Evento=at(5), Estado_Actual="Retrasado"), message(ID_Vuelo="AA2"), b"junk"],
    [message(ID_Vuelo="AA1", Timestamp_Evento=at(1)), message(ID_Vuelo="AA3_ERR"), message(ID_Vuelo="AA4", Timestamp_Evento=at(2))],
    [message(ID_Vuelo="AA1", Timestamp_Evento=at(9), Puerta_Asignada="C7"), message(ID_Vuelo="AA4", Timestamp_Evento=at(1)), None],
]


def land(spark, folder, *files):
    """One parquet file per list of bodies, arriving in the given order."""
    folder.mkdir(parents=True, exist_ok=True)
    for payloads in files:
        n = len(list(folder.iterdir()))
        target = folder.parent / f"write-{n}"
        bodies(spark, *payloads).coalesce(1).write.parquet(str(target))
        (part,) = target.glob("part-*.parquet")
        arrived = folder / f"{n}.parquet"
        part.rename(arrived)
        os.utime(arrived, (1_700_000_000 + n, 1_700_000_000 + n))
    return str(folder)


def source(spark, path, schema="body binary"):
    return streams.read_events(spark, path=path, schema=schema, maxFilesPerTrigger="1")


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def all_events(spark, files=FILES):
    return tk.parse_events(bodies(spark, *itertools.chain(*files)))


@pytest.fixture
def history(spark, lake):
    name = lake.table_name("silver")
    flights = bronze(spark, {"ID_Vuelo": "AA1"}, {"ID_Vuelo": "AA1", "Destino": "LIM"}, {"ID_Vuelo": "AA9"})
    tables.overwrite_table(silver_flights(flights), name)
    return name


def test_bronze_then_silver(spark, lake, tmp_path):
    path = land(spark, tmp_path / "in", *FILES)
    raw, parsed = lake.table_name("bronze", stream=True), lake.table_name("silver", stream=True)
    query = finish(jobs.start_bronze(source(spark, path), raw, lake.checkpoint("b")))
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert rows(spark.table(raw)) == rows(bodies(spark, *itertools.chain(*FILES)))
    finish(jobs.start_silver(streams.follow_table(spark, raw), parsed, lake.checkpoint("s")))
    assert rows(spark.table(parsed)) == rows(all_events(spark))


def test_rejects(spark, lake, tmp_path):
    path = land(spark, tmp_path / "in", *FILES)
    name = lake.table_name("silver", stream=True, table=jobs.REJECTS_TABLE)
    finish(jobs.start_rejects(source(spark, path), name, lake.checkpoint("r")))
    assert rows(spark.table(name)) == rows(bodies(spark, b"junk", None))


def test_all_jobs_run_side_by_side(spark, lake, tmp_path, history):
    path = land(spark, tmp_path / "in", *FILES)
    queries = jobs.start_all(spark, lake, source(spark, path), every="1 second")
    try:
        for query in queries:
            query.processAllAvailable()
        # A late file passes through every job.
        land(spark, tmp_path / "in", [message(ID_Vuelo="AA1", Timestamp_Evento=at(60))])
        for query in queries:
            query.processAllAvailable()
        assert all(query.isActive for query in queries)
    finally:
        for query in queries:
            query.stop()
    assert spark.table(lake.table_name("silver", stream=True)).count() == 10
    current = jobs.read_current(spark, lake.table_name("gold", stream=True, table=jobs.CURRENT_TABLE))
    assert {r.tracking_key: r.tracking_timestamp_evento for r in current.collect()}["AA1"] == at(60)


def test_a_restart_takes_only_new_files(spark, lake, tmp_path):
    path = land(spark, tmp_path / "in", FILES[0])
    raw = lake.table_name("bronze", stream=True)
    finish(jobs.start_bronze(source(spark, path), raw, lake.checkpoint("b")))
    land(spark, tmp_path / "in", FILES[1])
    finish(jobs.start_bronze(source(spark, path), raw, lake.checkpoint("b")))
    assert rows(spark.table(raw)) == rows(bodies(spark, *FILES[0], *FILES[1]))


@pytest.mark.parametrize("side", ["history", "active"])
def test_gold_writes_the_joined_states_of_each_batch(spark, lake, tmp_path, history, side):
    path = land(spark, tmp_path / "in", *FILES)
    name = lake.table_name("gold", stream=True)
    finish(jobs.start_gold(source(spark, path), history, name, lake.checkpoint("g"), side=side))
    assert tables.batch_ids(spark, name) == [0, 1, 2]
    for batch_id, payloads in enumerate(FILES):
        latest = tk.latest_state(tk.parse_events(bodies(spark, *payloads)))
        expected = jobs.SIDES[side](spark.table(history), latest)
        stored = spark.table(name).where(f"batch_id = {batch_id}").drop("batch_id", jobs.HISTORY_VERSION)
        assert rows(stored) == rows(expected)


def test_gold_batch_can_be_replayed(spark, lake, tmp_path, history):
    name = lake.table_name("gold", stream=True)
    write = jobs.gold_batch_writer(history, name, str(tmp_path / "staging"))
    write(all_events(spark), 0)
    write(all_events(spark, FILES[:1]), 1)
    before = rows(spark.table(name))
    write(all_events(spark, FILES[:1]), 1)
    assert rows(spark.table(name)) == before


def test_gold_without_adaptive_execution_salts_heavy_flights(spark, lake, tmp_path, history, conf):
    name = lake.table_name("gold", stream=True)
    write = jobs.gold_batch_writer(history, name, str(tmp_path / "staging"))
    write(all_events(spark), 0)
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    assert "AA1" in enrich.skew_plan(spark.table(history), tk.latest_state(all_events(spark))).parts
    write(all_events(spark), 1)
    batches = [rows(spark.table(name).where(f"batch_id = {b}").drop("batch_id")) for b in (0, 1)]
    assert batches[0] == batches[1]


def test_stream_session_takes_over_settings(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="12345", spark__sql__adaptive__enabled="false")
    session = stream_session(spark, state_partitions=3)
    assert session.conf.get("spark.sql.autoBroadcastJoinThreshold") == "12345"
    assert session.conf.get("spark.sql.adaptive.enabled") == "false"
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.shuffle.partitions") != "3"


@pytest.mark.parametrize("side", ["history", "active"])
def test_the_stored_gold_table_has_one_current_row_set(spark, lake, tmp_path, history, side):
    """Also where a later batch brings an older event of a flight."""
    name = lake.table_name("gold", stream=True)
    write = jobs.gold_batch_writer(history, name, str(tmp_path / "staging"), side=side)
    for batch_id, payloads in enumerate(FILES):
        write(tk.parse_events(bodies(spark, *payloads)), batch_id)
    expected = jobs.SIDES[side](spark.table(history), tk.latest_state(all_events(spark)))
    assert rows(jobs.read_gold(spark, name)) == rows(expected)


def test_gold_skips_an_empty_batch(spark, lake, tmp_path, history):
    name = lake.table_name("gold", stream=True)
    jobs.gold_batch_writer(history, name, str(tmp_path / "staging"))(all_events(spark).limit(0), 0)
    assert not spark.catalog.tableExists(name)


def test_gold_batch_of_unusable_events_keeps_the_history(spark, lake, tmp_path, history):
    name = lake.table_name("gold", stream=True)
    jobs.gold_batch_writer(history, name, str(tmp_path / "staging"))(all_events(spark, [[b"junk"]]), 0)
    stored = spark.table(name)
    assert stored.count() == 3 and stored.where("tracking_timestamp_evento is not null").count() == 0


def test_gold_sees_history_loaded_after_the_start(spark, lake, tmp_path, history):
    name = lake.table_name("gold", stream=True)
    write = jobs.gold_batch_writer(history, name, str(tmp_path / "staging"))
    write(all_events(spark), 0)
    tables.overwrite_table(silver_flights(bronze(spark, {"ID_Vuelo": "AA2"})), history)
    write(all_events(spark), 1)
    assert {r.id_vuelo for r in spark.table(name).where("batch_id = 1").collect()} == {"AA2"}


def test_gold_sees_history_files_replaced_by_another_application(spark, lake, tmp_path, history):
    name = lake.table_name("gold", stream=True)
    write = jobs.gold_batch_writer(history, name, str(tmp_path / "staging"))
    write(all_events(spark), 0)
    place = spark.sql(f"DESCRIBE EXTENDED {history}").where("col_name = 'Location'").first()[1]
    folder = Path(place.removeprefix("file:"))
    silver_flights(bronze(spark, {"ID_Vuelo": "AA2"})).write.parquet(str(tmp_path / "new"))
    for file in folder.glob("*"):
        file.unlink()
    for file in folder.glob(".*.crc"):
        file.unlink()
    for file in (tmp_path / "new").glob("part-*"):
        shutil.copy(file, folder / file.name)
    write(all_events(spark), 1)
    assert {r.id_vuelo for r in spark.table(name).where("batch_id = 1").collect()} == {"AA2"}


@pytest.mark.parametrize("stateful", [True, False])
@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_current_state_does_not_depend_on_arrival(spark, lake, tmp_path, stateful, order):
    path = land(spark, tmp_path / "in", *(FILES[i] for i in order))
    name = lake.table_name("gold", stream=True, table="estado_actual")
    session = stream_session(spark, state_partitions=2)
    finish(jobs.start_current(source(session, path), name, lake.checkpoint("c"), stateful=stateful))
    expected = rows(tk.latest_state(all_events(spark)))
    assert rows(jobs.read_current(spark, name)) == expected
    if stateful:
        newest = spark.table(name).groupBy("ID_Vuelo").agg({"batch_id": "max"})
        newest = newest.withColumnRenamed("max(batch_id)", "batch_id")
        last = spark.table(name).join(newest, ["ID_Vuelo", "batch_id"]).select(*TRACKING_EVENT.fieldNames())
        assert rows(tk.tracking_view(last)) == expected


def test_compaction_keeps_the_answer(spark, lake, tmp_path):
    path = land(spark, tmp_path / "in", *FILES)
    name = lake.table_name("gold", stream=True, table="estado_actual")
    start = lambda: finish(jobs.start_current(source(spark, path), name, lake.checkpoint("c"), stateful=False))
    start()
    before = rows(jobs.read_current(spark, name))
    assert jobs.compact_current(spark, name) == -1
    assert tables.batch_ids(spark, name) == [-1, 2]  # the newest batch may be replayed yet
    assert jobs.compact_current(spark, name) is None
    assert rows(jobs.read_current(spark, name)) == before
    land(spark, tmp_path / "in", [message(ID_Vuelo="AA2", Timestamp_Evento=at(30))])
    start()
    # A replay of an old batch after the merge, and a second merge.
    tables.write_batch(tk.clean_events(tk.parse_events(bodies(spark, *FILES[1]))), name, 1)
    after = rows(tk.latest_state(all_events(spark, [*FILES, [message(ID_Vuelo="AA2", Timestamp_Evento=at(30))]])))
    assert rows(jobs.read_current(spark, name)) == after
    assert jobs.compact_current(spark, name) == -2
    assert rows(jobs.read_current(spark, name)) == after


def test_processing_time_trigger_runs_until_stopped(spark, lake, tmp_path):
    path = land(spark, tmp_path / "in", *FILES)
    raw = lake.table_name("bronze", stream=True)
    query = jobs.start_bronze(source(spark, path), raw, lake.checkpoint("b"), every="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert spark.table(raw).count() == 9


def test_preview_holds_the_first_rows_only(spark, tmp_path):
    path = land(spark, tmp_path / "in", *FILES)
    finish(jobs.preview(source(spark, path), "look", rows=4))
    assert spark.table("look").count() == 4


def test_preview_stops_when_it_is_full(spark, tmp_path):
    path = land(spark, tmp_path / "in", *FILES, *(FILES[0] for _ in range(30)))
    query = jobs.preview(source(spark, path), "short", rows=2)
    assert not query.isActive and spark.table("short").count() == 2
    files = sum(p["numInputRows"] for p in query.recentProgress) / 3
    assert files < 33


def test_file_source_has_the_event_envelope_by_default(spark, tmp_path):
    path = land(spark, tmp_path / "in", FILES[0])
    assert streams.read_events(spark, path=path).schema == EVENT_ENVELOPE


def test_broker_options_pass_through(spark):
    stream = streams.read_events(spark, "rate", rowsPerSecond="3")
    assert "body" in stream.columns and "value" not in stream.columns
    with pytest.raises(Exception, match="eventhubs"):
        streams.read_events(spark, "eventhubs", **{"eventhubs.eventHubName": "hub"})


@pytest.fixture
def merging(spark, lake, tmp_path, history):
    name = lake.table_name("gold", stream=True)
    merged = lake.table_name("gold", stream=True, table=jobs.MERGED_TABLE)
    staging = str(tmp_path / "staging")

    def write(side, batch_id, payloads):
        jobs.gold_batch_writer(history, name, staging, side=side)(tk.parse_events(bodies(spark, *payloads)), batch_id)

    def merge(side):
        return jobs.merge_gold(spark, history, name, merged, staging, side=side)

    return name, merged, write, merge


def load(spark, history, parts=0):
    """Another load: AA1 with other seats, AA4 new, AA9 gone."""
    flights = silver_flights(bronze(spark, {"ID_Vuelo": "AA1", "Capacidad_Pasajeros": 7}, {"ID_Vuelo": "AA4"}))
    if parts:
        flights = buckets.add(flights, parts)
    tables.overwrite_table(flights, history, partition_by=[buckets.column(parts)] if parts else [])


@pytest.mark.parametrize("parts", [0, 4])
@pytest.mark.parametrize("side", ["history", "active"])
def test_merged_rows_are_of_one_load(spark, history, merging, side, parts):
    name, merged, write, merge = merging
    assert merge(side) == 0
    write(side, 0, FILES[0])
    write(side, 1, FILES[1])
    assert merge(side) == 2

    def expected(files):
        flights = buckets.without(spark.table(history))
        return rows(jobs.SIDES[side](flights, tk.latest_state(all_events(spark, files))))

    assert rows(jobs.read_merged(spark, merged)) == expected(FILES[:2])
    load(spark, history, parts)
    assert merge(side) == 1  # the newest batch is left, as it may be replayed
    assert rows(jobs.read_merged(spark, merged)) == expected(FILES[:2])
    write(side, 2, FILES[2])
    with pytest.raises(ValueError, match="several loads"):
        jobs.read_gold(spark, name)
    assert rows(jobs.read_gold(spark, name, history, side=side)) == expected(FILES)
    merge(side)
    first = rows(jobs.read_merged(spark, merged))
    assert first == expected(FILES)
    merge(side)
    assert rows(jobs.read_merged(spark, merged)) == first


def test_merging_keeps_one_batch_and_few_states(spark, merging):
    name, merged, write, merge = merging
    for batch_id in range(6):
        write("active", batch_id, FILES[batch_id % 3])
    merge("active")
    assert tables.batch_ids(spark, name) == [5]
    states = jobs.states_table(name)
    assert tables.batch_ids(spark, states) == [-1, 5]
    write("active", 5, FILES[2])  # a replay of the newest batch
    write("active", 6, FILES[0])
    before = rows(jobs.read_merged(spark, merged))
    merge("active")
    assert tables.batch_ids(spark, states) == [-2, 6] and rows(jobs.read_merged(spark, merged)) == before


def test_a_reload_during_a_batch_does_not_disturb_it(spark, lake, tmp_path, history, monkeypatch):
    name = lake.table_name("gold", stream=True)
    join = jobs.SIDES["history"]

    def reloading(flights, latest, heavy=None):
        load(spark, history)
        return join(flights, latest, heavy)

    before = rows(join(spark.table(history), tk.latest_state(all_events(spark))))
    monkeypatch.setitem(jobs.SIDES, "history", reloading)
    jobs.gold_batch_writer(history, name, str(tmp_path / "staging"))(all_events(spark), 0)
    stored = spark.table(name)
    assert rows(stored.drop("batch_id", jobs.HISTORY_VERSION)) == before
    assert {r[0] for r in stored.select(jobs.HISTORY_VERSION).collect()} != {tables.version(spark, history)}


HOUR = Horizon(dt.timedelta(hours=1), dt.timedelta(hours=3))


def states_of(spark, name, horizon=HOUR):
    found = jobs.read_current(spark, name, horizon=horizon).collect()
    return {r.tracking_key: r.estado_actual_normalizado for r in found}


def log_of(spark, name, *batches, compact=()):
    write = jobs.current_batch_writer(name, horizon=HOUR)
    for batch_id, events in enumerate(batches):
        payloads = [message(ID_Vuelo=f, Timestamp_Evento=at(m), Estado_Actual=e) for f, m, e in events]
        write(tk.clean_events(tk.parse_events(bodies(spark, *payloads))), batch_id)
        if batch_id in compact:
            jobs.compact_current(spark, name, horizon=HOUR)


BATCHES = [
    [("A", 0, " aterrizado"), ("B", 0, "En Vuelo"), ("C", 0, "Cancelado"), ("D", 200, "En Vuelo")],
    [("C", 139, "En Vuelo"), ("E", 140, "Aterrizado"), ("A", 10, "En Vuelo")],  # clock 200: C, A late
    [("E", 201, "Puerta Asignada"), ("F", 260, "Cancelado")],
    [("F", 190, "En Vuelo"), ("G", 320, "En Vuelo")],  # clock 260: F late
]


@pytest.mark.parametrize("compact", [(), (1, 2), (1, 2, 3)])
def test_flights_leave_and_late_events_are_not_taken(spark, lake, compact):
    name = lake.table_name("gold", stream=True, table=jobs.CURRENT_TABLE)
    log_of(spark, name, *BATCHES, compact=compact)
    # The clock is 320: F finished an hour ago and stays, B was silent for more than three.
    assert states_of(spark, name) == {
        "D": "EN VUELO", "E": "PUERTA ASIGNADA", "F": "CANCELADO", "G": "EN VUELO",
    }
    told = spark.table(jobs.clock_table(name)).agg({"eventos": "sum", "tardios": "sum", "hasta": "max"}).first()
    assert told["sum(eventos)"] == 11 and told["sum(tardios)"] == 3
    assert told["max(hasta)"] == int((at(320) - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)


def test_a_replay_takes_the_same_events(spark, lake):
    name = lake.table_name("gold", stream=True, table=jobs.CURRENT_TABLE)
    log_of(spark, name, *BATCHES)
    before, rows_before = states_of(spark, name), rows(spark.table(name))
    log_of(spark, name, *BATCHES[:2])
    assert states_of(spark, name) == before and rows(spark.table(name)) == rows_before


def test_rows_of_the_log_are_bounded_by_what_flies(spark, lake):
    """Every batch brings new flights that land; the log keeps those of the last hour."""
    name = lake.table_name("gold", stream=True, table=jobs.CURRENT_TABLE)
    days = [[(f"X{b}-{i}", 120 * b, "Aterrizado") for i in range(10)] for b in range(8)]
    log_of(spark, name, *days, compact=range(8))
    assert spark.table(name).count() <= 20
    assert spark.table(jobs.clock_table(name)).count() <= 3


def test_a_horizon_is_for_the_log(spark, lake):
    with pytest.raises(ValueError, match="finished"):
        Horizon(dt.timedelta(hours=2), dt.timedelta(hours=1))
    with pytest.raises(ValueError, match="log"):
        jobs.start_current(None, "x", "y", stateful=True, horizon=HOUR)
