"""What merges, loads and batches have on disk at a time."""

import datetime as dt
import uuid
from pathlib import Path

import pytest

from skyledger.operators import buckets, enrich
from skyledger.operators import tracking as tk
from skyledger.operators.silver import silver_flights
from skyledger.plans import queries
from skyledger.plans.queries import QUERIES
from skyledger.sources import tables
from skyledger.streaming import jobs
from tests.data import bodies, bronze, message, rows

T0 = dt.datetime(2025, 3, 9, 12, 0)


def folders(root) -> list[str]:
    """Folders of loads and batches below ``root``, live or not, those of states apart."""
    found = {p.parent for p in Path(root).rglob("*.parquet")}
    found = {next((q for q in (p, *p.parents) if tables.is_load(q.name.rsplit("-", 1)[-1])), None) for p in found}
    return sorted(str(p.relative_to(root)) for p in found - {None} if "estados" not in str(p))


@pytest.fixture
def watched(spark, monkeypatch):
    """Folders at the end of each write, and before what a load replaces is given up."""
    seen = []

    def after(name, root):
        work = getattr(tables, name)

        def run(*args, **kwargs):
            if name == "_make_live":
                seen.append(folders(root))
            work(*args, **kwargs)
            seen.append(folders(root))

        monkeypatch.setattr(tables, name, run)

    def watch(root):
        for name in ("_make_live", "write_batch"):
            after(name, root)
        return seen

    return watch


@pytest.fixture
def small(spark, tmp_path):
    """Line items of eight orders and events of the four hub partitions."""
    lines = [
        (order, order + line, order % 3 + 1, line, 5.0, 1000.0 + order, 0.0, 0.02, "N", "O", dt.datetime(1996, 1 + (order + 3 * line) % 12, 5))
        for order in range(1, 9)
        for line in (1, 2, 3)
    ]
    events = [
        (i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), i % 12, ("click", "view", "error", "signup")[i % 4], 1.5 * i, "{}")
        for i in range(1, 60)
    ]
    wanted = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, wanted).write.parquet(f"{tmp_path}/in/lineitem.parquet")
    wanted = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, wanted).write.parquet(f"{tmp_path}/in/events.parquet")
    return f"{tmp_path}/in"


@pytest.mark.parametrize("name", ["gold_merged", "gold_reloaded", "bi_total_merged"])
def test_the_queries_hold_live_rows_only_and_shuffle_no_load(spark, small, tmp_path, monkeypatch, watched, name):
    shared = tmp_path / "shared"
    monkeypatch.setattr(queries, "shared_scratch", lambda _, label: f"{shared}/{label}-{uuid.uuid4().hex[:12]}")
    frame, hints = type(spark.range(1)), []
    hint = frame.hint
    monkeypatch.setattr(frame, "hint", lambda df, kind, *args: hints.append(kind) or hint(df, kind, *args))
    seen = watched(shared)
    result = QUERIES[name](spark, small)
    # The history, the newest merged batch, two batches and the merged rows; a merge and a load need less.
    assert max(map(len, seen)) == 5
    left = folders(shared)
    assert len(left) == 2 and sum("vuelos_actual/" in p for p in left) == 1
    assert "rebalance" not in hints
    if name == "bi_total_merged":
        assert [tuple(r) for r in result.collect()] == [tuple(r) for r in QUERIES["bi_total"](spark, small).collect()]
    else:
        assert rows(result) == rows(QUERIES["latest_state_enriched"](spark, small)) and result.count() == 24


@pytest.mark.parametrize("grace", [0, tables.GRACE_SECONDS])
@pytest.mark.parametrize("side", ["history", "active"])
def test_a_stopped_merge_is_completed_by_the_next(spark, lake, tmp_path, monkeypatch, side, grace):
    history, name = lake.table_name("silver"), lake.table_name("gold", stream=True)
    merged = lake.table_name("gold", stream=True, table=jobs.MERGED_TABLE)
    staging = str(tmp_path / "staging")
    flights = [{"ID_Vuelo": f"AA{n}"} for n in (1, 1, 2, 3)] + [{"ID_Vuelo": None}]
    tables.overwrite_table(silver_flights(bronze(spark, *flights)), history)
    write = jobs.gold_batch_writer(history, name, staging, side=side)
    sent = []

    def send(batch_id, *ids):
        sent.extend(message(ID_Vuelo=i, Timestamp_Evento=T0 + dt.timedelta(minutes=batch_id)) for i in ids)
        write(tk.parse_events(bodies(spark, *sent[-len(ids):])), batch_id)

    def merge():
        return jobs.merge_gold(spark, history, name, merged, staging, side=side, grace_seconds=grace)

    def expected():
        return rows(jobs.SIDES[side](spark.table(history), tk.latest_state(tk.parse_events(bodies(spark, *sent)))))

    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as broken:
        send(0, "AA1", "AA9")
        send(1, "AA2")
        broken.setattr(tables, "_make_live", fail)
        with pytest.raises(RuntimeError, match="stopped"):
            merge()
    assert merge() == 2 and rows(jobs.read_merged(spark, merged)) == expected()
    before = expected()
    send(2, "AA1")
    send(3, "AA3", "AA9")
    with monkeypatch.context() as broken:
        broken.setattr(tables, "_make_live", fail)
        with pytest.raises(RuntimeError, match="stopped"):
            merge()
    assert rows(jobs.read_merged(spark, merged)) == before
    merge()
    assert rows(jobs.read_merged(spark, merged)) == expected() != before
    assert tables.batch_ids(spark, name) == [3]


def test_a_load_that_is_not_gathered_has_the_same_rows(spark, lake):
    flights = silver_flights(bronze(spark, *({"ID_Vuelo": f"AA{i}" if i % 7 else None} for i in range(60)))).repartition(3)
    parts, files, stored = [buckets.column(4)], {}, {}
    for gather in (True, False):
        name = lake.table_name("silver", table=f"vuelos_{gather}".lower())
        tables.overwrite_table(buckets.add(flights, 4), name, partition_by=parts, gather=gather)
        files[gather], stored[gather] = len(spark.table(name).inputFiles()), rows(spark.table(name))
    assert stored[True] == stored[False] and len(stored[True]) == 60
    assert files == {True: 4, False: 12}
    latest = tk.latest_state(tk.parse_events(bodies(spark, message(ID_Vuelo="AA3"))))
    assert enrich.touched_flights(spark.table(name), latest).count() == 1


def test_tables_are_packed_unless_the_session_names_a_codec(spark, lake, conf):
    numbers, name, log = spark.range(5), lake.table_name("silver"), lake.table_name("gold", stream=True)

    def codecs():
        tables.overwrite_table(numbers, name)
        tables.write_batch(numbers, log, 0)
        return {file.rsplit(".", 2)[1] for one in (name, log) for file in spark.table(one).inputFiles()}

    assert codecs() == {"zstd"}
    conf(spark__sql__parquet__compression__codec="gzip")
    assert codecs() == {"gz"}
    assert spark.table(name).count() == spark.table(log).count() == 5
