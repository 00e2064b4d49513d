"""Loads and batches under failures, stops and running readers."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyledger.sources import tables
from tests.data import rows

OLD, NEW = [(1, "v1"), (2, "v2")], [(3, "v3")]


def numbers(spark, *values):
    return spark.createDataFrame([(v, f"v{v}") for v in values], "n int, t string")


def folders(spark, name):
    base = Path(tables.table_folder(spark, name).removeprefix("file:"))
    return sorted(p.name for p in base.iterdir() if p.is_dir())


def collected(reader):
    """The rows of a reader as it was planned."""
    return sorted(map(tuple, reader.collect()))


class Stopped(Exception):
    pass


@pytest.fixture
def stop_at(spark, monkeypatch):
    """Ends the work before its n-th statement that changes the catalog."""
    run = type(spark).sql

    def arm(n):
        left = [n]

        def sql(self, text, *args, **kwargs):
            if text.split()[0] in ("ALTER", "DROP", "CREATE"):
                left[0] -= 1
                if left[0] < 0:
                    raise Stopped(text)
            return run(self, text, *args, **kwargs)

        monkeypatch.setattr(type(spark), "sql", sql)

    yield arm
    monkeypatch.setattr(type(spark), "sql", run)


@pytest.mark.parametrize("n", range(6))
@pytest.mark.parametrize("change", ["rows", "column more", "column less", "partitions"])
def test_a_stop_leaves_the_old_or_the_new_rows(spark, lake, stop_at, monkeypatch, n, change):
    name = lake.table_name("bronze")
    parts = ["n"] if change == "partitions" else []
    tables.overwrite_table(numbers(spark, 1, 2), name, partition_by=parts)
    new = numbers(spark, 3)
    if change == "column more":
        new = new.withColumn("x", F.lit(7))
    if change == "column less":
        new = new.select("n")
    run = type(spark).sql
    stop_at(n)
    try:
        tables.overwrite_table(new, name, partition_by=parts)
        stopped = False
    except Stopped:
        stopped = True
    monkeypatch.setattr(type(spark), "sql", run)
    found = {r.n for r in tables.read_table(spark, name).collect()}
    assert found in ({1, 2}, {3}) and (stopped or found == {3})
    # The next load is not hindered by what was left.
    tables.overwrite_table(numbers(spark, 8, 9), name, partition_by=parts)
    assert rows(tables.read_table(spark, name).select("n", "t")) == [(8, "v8"), (9, "v9")]
    assert not spark.catalog.tableExists(name + tables.NEXT)


@pytest.mark.parametrize("parts", [[], ["n"]])
def test_a_reader_opened_before_a_load_finishes(spark, lake, parts):
    name = lake.table_name("silver")
    tables.overwrite_table(numbers(spark, 1, 2), name, partition_by=parts)
    reader = spark.table(name).select("n", "t")
    reader._jdf.queryExecution().executedPlan()
    tables.overwrite_table(numbers(spark, 3), name, partition_by=parts)
    # Partitions are listed when the reader starts, all of one load.
    assert collected(reader) in ([OLD, NEW] if parts else [OLD])
    assert rows(spark.table(name).select("n", "t")) == NEW


def test_a_reader_opened_before_a_replay_finishes(spark, lake):
    name = lake.table_name("gold", stream=True)
    tables.write_batch(numbers(spark, 1, 2), name, 0)
    reader = spark.table(name).select("n", "t")
    started = reader.rdd  # the files to read are listed here
    started.getNumPartitions()
    tables.write_batch(numbers(spark, 3), name, 0)
    assert sorted(map(tuple, started.collect())) == OLD
    tables.drop_batches(spark, name, [0])
    assert collected(reader) in (OLD, NEW, []) and spark.table(name).count() == 0


def test_a_replay_whose_values_do_not_fit_leaves_the_batch(spark, lake):
    name = lake.table_name("gold", stream=True)
    tables.write_batch(spark.range(5).withColumn("t", F.lit("a")), name, 0)
    before = folders(spark, name)
    words = spark.createDataFrame([("x1", "b"), ("7", "c")], "id string, t string")
    with pytest.raises(Exception, match="no bigint for id: x1"):
        tables.write_batch(words, name, 0)
    assert spark.table(name).count() == 5 and folders(spark, name) == before
    tables.write_batch(words.where("t = 'c'"), name, 0)
    assert rows(spark.table(name).select("id", "t")) == [(7, "c")]


@pytest.mark.parametrize("n", range(3))
def test_a_stopped_batch_can_be_written_again(spark, lake, stop_at, monkeypatch, n):
    name = lake.table_name("gold", stream=True)
    tables.write_batch(numbers(spark, 1, 2), name, 0)
    run = type(spark).sql
    stop_at(n)
    try:
        tables.write_batch(numbers(spark, 3).withColumn("x", F.lit(1)), name, 0)
    except Stopped:
        pass
    monkeypatch.setattr(type(spark), "sql", run)
    assert {r.n for r in spark.table(name).collect()} in ({1, 2}, {3})
    tables.write_batch(numbers(spark, 3).withColumn("x", F.lit(1)), name, 0)
    assert {r.n for r in spark.table(name).collect()} == {3}


def test_a_batch_is_written_once(spark, lake):
    name = lake.table_name("gold", stream=True)
    tables.write_batch(numbers(spark, 1, 2), name, 0)
    tables.write_batch(numbers(spark, 3), name, 1)
    assert [f.split("-")[0] for f in folders(spark, name)] == ["batch_id=0", "batch_id=1"]
    stored = spark.table(name).inputFiles()
    assert all(f"/{lake.table}/batch_id=" in f for f in stored)


def test_sweep_removes_what_is_retired_and_keeps_what_is_live(spark, lake):
    loads, batches = lake.table_name("silver"), lake.table_name("gold", stream=True)
    for value in (1, 2, 3):
        tables.overwrite_table(numbers(spark, value), loads)
        tables.write_batch(numbers(spark, value), batches, 0)
        tables.write_batch(numbers(spark, value), batches, value)
    tables.drop_batches(spark, batches, [2])
    assert len(folders(spark, loads)) == 3 and len(folders(spark, batches)) == 6
    assert tables.sweep(spark, loads) == tables.sweep(spark, batches) == []
    assert len(tables.sweep(spark, loads, 0)) == 2 and len(tables.sweep(spark, batches, 0)) == 3
    assert rows(spark.table(loads)) == NEW and tables.batch_ids(spark, batches) == [0, 1, 3]
    assert sorted(r.n for r in spark.table(batches).collect()) == [1, 3, 3]


def test_sweep_marks_what_a_failed_load_left_before_it_goes(spark, lake):
    name = lake.table_name("silver")
    tables.overwrite_table(numbers(spark, 1), name)
    left = f"{tables.table_folder(spark, name)}/v0000000000001_deadbeef"
    numbers(spark, 9).write.parquet(left)
    assert tables.sweep(spark, name, 60) == [] and tables.path_exists(spark, f"{left}/{tables.RETIRED}")
    assert tables.sweep(spark, name, 0) == [left] and not tables.path_exists(spark, left)


def test_dropping_a_table_removes_all_its_rows(spark, lake):
    name = lake.table_name("silver")
    for value in (1, 2):
        tables.overwrite_table(numbers(spark, value), name)
    folder = tables.table_folder(spark, name)
    tables.drop_tables(spark, [name])
    assert not tables.path_exists(spark, folder)
    tables.overwrite_table(numbers(spark, 1), name)
    tables.drop_schema(spark, lake.schema("silver"), confirm=lake.schema("silver"))
    assert not tables.path_exists(spark, folder)


def test_another_format_replaces_the_table(spark, lake):
    name = lake.table_name("silver")
    tables.overwrite_table(numbers(spark, 1), name)
    tables.overwrite_table(numbers(spark, 3), name, "orc")
    assert rows(spark.table(name)) == NEW
