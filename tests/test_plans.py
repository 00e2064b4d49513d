"""Shape of the physical plans the jobs rely on."""

import datetime as dt
import re

import pytest

from skyledger.operators import bi, buckets, enrich, gold
from skyledger.operators import tracking as tk
from skyledger.operators.silver import silver_flights
from skyledger.sources import tables
from tests.data import bodies, bronze, message, rows


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("Initial Plan")[-1]


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver_flights(bronze(spark, {}, {"ID_Vuelo": "AA2"})).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def parsed(spark, tmp_path):
    path = str(tmp_path / "events")
    bodies(spark, message(), message(ID_Vuelo="AA2")).write.parquet(path)
    return tk.parse_events(spark.read.parquet(path))


def read_columns(text: str) -> set[str]:
    return set(re.findall(r"(\w+)#", re.search(r"FileScan parquet \[(.*?)\]", text).group(1)))


def test_gold_reads_nine_columns_and_shuffles_partial_sums_once(stored):
    text = plan(gold.monthly_by_route(stored))
    assert len(read_columns(text)) == 9
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text


def test_dashboard_reads_what_it_shows_and_pushes_its_filters(stored):
    text = plan(bi.passengers_by_month(stored, bi.BiFilter(years=[2025], months=[3])))
    assert read_columns(text) == {"analisis_anio", "analisis_mes", "op_pasajeros_reservados"}
    assert "EqualTo(analisis_anio,2025)" in text or "In(analisis_anio" in text
    assert plan(bi.flights_by_month(stored)).count("Exchange hashpartitioning") == 2


def test_events_are_parsed_once(parsed):
    for df in (tk.clean_events(parsed), tk.latest_state(parsed)):
        assert plan(df).count("from_json(") == 1


def test_latest_state_is_reduced_before_the_shuffle(parsed):
    text = plan(tk.latest_state(parsed))
    assert re.search(r"WindowGroupLimit.*Final(.|\n)*Exchange(.|\n)*WindowGroupLimit.*Partial", text)
    text = plan(tk.latest_state(parsed, pick=tk.latest_by_max))
    assert re.search(r"max\((.|\n)*Exchange(.|\n)*partial_max\(", text)
    assert text.count("Exchange hashpartitioning") == 1


def test_small_states_are_broadcast_and_the_history_is_not_shuffled(stored, parsed, tmp_path):
    latest = tables.settle(tk.latest_state(parsed), str(tmp_path / "latest"))
    text = plan(enrich.flights_with_state(stored, latest))
    assert "BroadcastHashJoin" in text and "BuildRight" in text
    assert "Exchange hashpartitioning" not in text
    text = plan(enrich.active_with_history(stored, latest))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in text


def test_settled_matches_spare_the_second_scan_of_the_history(spark, stored, parsed, tmp_path):
    latest = tables.settle(tk.latest_state(parsed), str(tmp_path / "latest"))
    once = enrich.active_with_history(stored, latest, staging=str(tmp_path / "matched"))
    assert not any("/silver/" in f for f in once.inputFiles())
    assert rows(once) == rows(enrich.active_with_history(stored, latest))


def test_large_states_are_not_broadcast(stored, parsed, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="10")
    latest = tables.settle(tk.latest_state(parsed), str(tmp_path / "latest"))
    for df in (enrich.flights_with_state(stored, latest), enrich.active_with_history(stored, latest)):
        text = plan(df)
        assert "SortMergeJoin" in text and "Broadcast" not in text and "Cartesian" not in text


def test_dates_alone_skip_partitions(spark, lake):
    name = lake.table_name("silver")
    tables.overwrite_table(
        silver_flights(bronze(spark, {})), name, partition_by=["analisis_anio", "analisis_mes"]
    )
    days = bi.BiFilter(date_from=dt.date(2025, 2, 1), date_to=dt.date(2025, 4, 30))
    text = plan(bi.passengers_by_month(tables.read_table(spark, name), days))
    filters = text[text.index("PartitionFilters: ["):].split("]")[0]
    assert "analisis_anio" in filters and "analisis_mes" in filters


def test_tracked_flights_read_their_parts_of_the_history_only(spark, lake, tmp_path):
    name = lake.table_name("silver")
    flights = silver_flights(bronze(spark, *({"ID_Vuelo": f"AA{i}"} for i in range(200))))
    tables.overwrite_table(buckets.add(flights, 16), name, partition_by=[buckets.column(16)])
    history = tables.snapshot(spark, name)[1]
    states = tk.latest_state(tk.parse_events(bodies(spark, message(ID_Vuelo="AA3"), message(ID_Vuelo="none"))))
    latest = tables.settle(states, str(tmp_path / "latest"))
    joined = enrich.touched_flights(history, latest)
    scan = re.search(r"FileScan parquet .*", plan(joined)).group(0)
    kept = re.search(r"PartitionFilters: \[.*?cubeta_vuelo_16#\w+ (?:IN \((.*?)\)|= (\d+))", scan)
    assert len((kept.group(1) or kept.group(2)).split(",")) <= 2
    whole = enrich.active_with_history(flights, latest)
    parts = enrich.active_with_history(history, latest, staging=str(tmp_path / "matched"))
    assert rows(parts) == rows(whole) and parts.count() == 2
    # A heavy flight in one part is split by adaptive execution as before: the join is on its id.
    assert "cubeta" not in ", ".join(parts.columns)
