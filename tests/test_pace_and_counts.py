"""Events at a given rate, and what batches say of themselves."""

import pytest
from pyspark.sql import functions as F

from skyledger.operators import tracking as tk
from skyledger.sources import generators, streams, tables
from skyledger.streaming import jobs, metrics, pace
from tests.data import bodies, message, rows


def test_paced_batches_hold_the_events_of_their_numbers(spark, lake, tmp_path):
    flights = generators.generate_flights(spark, 50).select("ID_Vuelo")
    path = str(tmp_path / "landing")
    pace.emit(spark, flights, path, 40, 3, lake.checkpoint("p"), seed=5, heavy_per_mille=300)
    landed = spark.read.parquet(path)
    assert {tuple(r) for r in landed.groupBy("lote").count().collect()} == {(0, 40), (1, 40), (2, 40)}
    drawn = generators.generate_events(spark, 120, flights, seed=5, heavy_per_mille=300)
    assert rows(landed.select("body")) == rows(drawn)
    # Started again, it goes on where it was: nothing is left to land.
    pace.emit(spark, flights, path, 40, 3, lake.checkpoint("p"), seed=5, heavy_per_mille=300)
    assert spark.read.parquet(path).count() == 120


def test_counts_of_each_batch(spark, lake, tmp_path):
    batches = [
        [message(), b"junk", message(ID_Vuelo=None), None],
        [message(Retraso_Minutos=None, Puerta_Asignada=None)],
    ]
    raw, counts = lake.table_name("bronze", stream=True), lake.table_name("silver", stream=True, table="conteos")
    silver, checkpoint = lake.table_name("silver", stream=True), lake.checkpoint("s")
    for payloads in batches:
        bodies(spark, *payloads).write.mode("append").saveAsTable(raw)
        query, listener = metrics.start_counted_silver(
            streams.follow_table(spark, raw), silver, counts, checkpoint, jobs.start_append
        )
        listener.wait(query)
        spark.streams.removeListener(listener)
    found = {r.batch_id: r for r in spark.table(counts).collect()}
    assert (found[0].filas, found[0].rechazadas, found[0].sin_id_vuelo) == (4, 2, 3)
    assert (found[1].filas, found[1].rechazadas, found[1].sin_retraso_minutos) == (1, 0, 1)
    assert tk.unreadable_events(spark.table(raw)).count() == sum(r.rechazadas for r in found.values())
    assert spark.table(silver).count() == 5 and found[0].hora is not None


def test_an_error_of_the_listener_reaches_the_waiting_job(spark, lake, monkeypatch):
    raw = lake.table_name("bronze", stream=True)
    bodies(spark, message()).write.mode("append").saveAsTable(raw)

    def broken(*_):
        raise RuntimeError("no table")

    monkeypatch.setattr(tables, "write_batch", broken)
    query, listener = metrics.start_counted_silver(
        streams.follow_table(spark, raw), lake.table_name("silver", stream=True),
        lake.table_name("silver", stream=True, table="conteos"), lake.checkpoint("s"), jobs.start_append,
    )
    with pytest.raises(RuntimeError, match="no table"):
        listener.wait(query)
    spark.streams.removeListener(listener)
    assert spark.table(lake.table_name("silver", stream=True)).agg(F.count("*")).first()[0] == 1
