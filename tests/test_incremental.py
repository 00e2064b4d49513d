"""Monthly results by load, resumed chains, bitmaps of flights."""

import dataclasses
import datetime as dt
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyledger.config import Rules
from skyledger.operators import bi, gold
from skyledger.operators.bronze import rename_flights
from skyledger.operators.silver import silver_flights
from skyledger.plans import batch
from skyledger.sources import csv_files, generators, tables
from tests.data import bronze, rows


def flights(spark, n=600):
    drawn = generators.generate_flights(spark, n)
    return silver_flights(rename_flights(drawn))


def months_of(spark, lake):
    name = lake.table_name("gold", table=batch.MONTHS_TABLE)
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    return {p: tables.location(spark, name, f"PARTITION ({p})") for p in parts}


def stored(spark, lake, table):
    return rows(spark.table(lake.table_name("gold", table=table)).drop(gold.PERIOD))


def test_a_load_replaces_its_months_only(spark, lake):
    tables.create_schemas(spark, lake)
    all_ = flights(spark)
    first, march = all_.where("analisis_mes <> 3"), all_.where("analisis_mes = 3")
    some = all_.where("analisis_mes = 5").limit(4)
    batch.load_increment(spark, lake, first, 0)
    before = months_of(spark, lake)
    assert batch.load_increment(spark, lake, march.unionByName(some), 1) == [202503, 202505]
    after = months_of(spark, lake)
    changed = {p for p in after if after[p] != before.get(p)}
    assert changed == {f"{gold.PERIOD}=202503", f"{gold.PERIOD}=202505"}
    expected = first.unionByName(march).unionByName(some)
    assert stored(spark, lake, batch.MONTHS_TABLE) == rows(gold.monthly_by_route(expected))
    assert stored(spark, lake, batch.AIRLINE_MONTHS_TABLE) == rows(gold.monthly_by_airline(expected))


def test_a_load_that_comes_again_takes_back_what_it_added(spark, lake):
    tables.create_schemas(spark, lake)
    all_ = flights(spark)
    batch.load_increment(spark, lake, all_.where("analisis_mes <= 6"), 0)
    batch.load_increment(spark, lake, all_.where("analisis_mes between 6 and 9"), 1)
    assert batch.load_increment(spark, lake, all_.where("analisis_mes = 12"), 1) == [202506, 202507, 202508, 202509, 202512]
    expected = all_.where("analisis_mes <= 6 or analisis_mes = 12")
    assert stored(spark, lake, batch.MONTHS_TABLE) == rows(gold.monthly_by_route(expected))
    assert f"{gold.PERIOD}=202508" not in months_of(spark, lake)


def test_flights_without_a_date_or_sums(spark, lake):
    tables.create_schemas(spark, lake)
    odd = silver_flights(
        bronze(spark, {"Fecha_Programada": None}, {"Capacidad_Pasajeros": None, "Costo_Base": None}, {"ID_Vuelo": None})
    )
    assert 0 in batch.load_increment(spark, lake, odd, 0)
    assert stored(spark, lake, batch.MONTHS_TABLE) == rows(gold.monthly_by_route(odd))
    assert stored(spark, lake, batch.AIRLINE_MONTHS_TABLE) == rows(gold.monthly_by_airline(odd))
    assert 0 in batch.load_increment(spark, lake, odd.limit(0), 0)
    assert stored(spark, lake, batch.MONTHS_TABLE) == []


def test_sweep_of_month_partitions(spark, lake):
    tables.create_schemas(spark, lake)
    all_ = flights(spark, 200)
    for load in range(3):
        batch.load_increment(spark, lake, all_.where("analisis_mes <= 2"), load)
    name = lake.table_name("gold", table=batch.MONTHS_TABLE)
    before = rows(spark.table(name))
    assert tables.sweep(spark, name, 0) == []  # marked first
    assert len(tables.sweep(spark, name, 0)) == 2 * len(months_of(spark, lake))
    assert rows(spark.table(name)) == before


@pytest.fixture
def csv_path(spark, tmp_path):
    path = str(tmp_path / "in")
    csv_files.write_flights(generators.generate_flights(spark, 300), path)
    return path


def loads(spark, cfg):
    names = [*(cfg.table_name(x) for x in ("bronze", "silver", "gold")), cfg.table_name("gold", table=batch.AIRLINE_TABLE)]
    return [tables.version(spark, n) for n in names]


def changed(spark, cfg, csv_path):
    before = loads(spark, cfg)
    batch.run(spark, cfg, csv_path, resume=True)
    return [a != b for a, b in zip(before, loads(spark, cfg))]


def test_a_resumed_chain_runs_what_is_missing_or_changed(spark, lake, csv_path, monkeypatch):
    def stopped(*_):
        raise RuntimeError("stopped")

    whole = batch.load
    monkeypatch.setattr(batch, "load", stopped)
    with pytest.raises(RuntimeError):
        batch.run(spark, lake, csv_path)
    monkeypatch.setattr(batch, "load", whole)
    silver = tables.version(spark, lake.table_name("silver"))
    assert batch.run(spark, lake, csv_path, resume=True) == {}
    assert tables.version(spark, lake.table_name("silver")) == silver
    assert changed(spark, lake, csv_path) == [False] * 4
    dear = dataclasses.replace(lake, rules=dataclasses.replace(Rules(), high_capacity_seats=200))
    assert changed(spark, dear, csv_path) == [False, True, True, True]
    more = f"{csv_path}2"
    csv_files.write_flights(generators.generate_flights(spark, 20, seed=9).coalesce(1), more)
    (part,) = Path(more).glob("part-*.csv")
    shutil.copy(part, f"{csv_path}/part-more.csv")
    assert changed(spark, dear, csv_path) == [True] * 4
    # Rows that came from elsewhere are not taken for the step's own.
    tables.overwrite_table(spark.table(lake.table_name("silver")).limit(5), lake.table_name("silver"))
    assert changed(spark, dear, csv_path) == [False, True, True, True]


def test_bitmaps_count_what_ids_would(spark, tmp_path):
    dates = [dt.date(2025, m, d) for m in (1, 2) for d in (1, 2, 3)]
    df = spark.range(4000).select(
        F.concat(F.lit("AA"), (F.col("id") % 700).cast("string")).alias("id_vuelo"),
        F.element_at(F.array(*map(F.lit, dates)), (F.col("id") % 6 + 1).cast("int")).alias(bi.DATE),
        F.lit(1).alias("op_pasajeros_reservados"),
    )
    df = df.unionByName(df.limit(9).withColumn("id_vuelo", F.lit(None).cast("string")))
    df = df.withColumns({bi.YEAR: F.year(bi.DATE), bi.MONTH: F.month(bi.DATE)})
    old = tables.settle(bi.number_flights(df.where("id_vuelo < 'AA5'")), str(tmp_path / "a"))
    new = tables.settle(bi.number_flights(df, old), str(tmp_path / "b"))
    numbers = old.unionByName(new)
    assert numbers.count() == numbers.select(bi.NUMBER).distinct().count() == 700
    parts = [bi.summarise_bitmaps(part, numbers) for part in (df.where("id_vuelo < 'AA3'"), df.where("not coalesce(id_vuelo < 'AA3', false)"))]
    summary = tables.settle(parts[0].unionByName(parts[1]), str(tmp_path / "s"))
    for picked in (bi.NO_FILTER, bi.BiFilter(date_from=dt.date(2025, 1, 2), months=(1,))):
        assert rows(bi.flights_by_month_bitmaps(summary, picked)) == rows(bi.flights_by_month(df, picked))
        assert rows(bi.total_flights(summary, picked, summary=True)) == rows(bi.total_flights(df, picked))
        assert rows(bi.passengers_by_month(summary, picked)) == rows(bi.passengers_by_month(df, picked))
    text = bi.flights_by_month_bitmaps(summary)._jdf.queryExecution().executedPlan().toString()
    assert "id_vuelo" not in text


def test_a_summary_with_bitmaps_is_small(spark, tmp_path):
    daily = spark.range(60_000).select(
        (F.col("id") % 2_000).cast("string").alias("id_vuelo"),
        F.expr("date_add(date'2025-01-01', cast(id div 2000 as int))").alias(bi.DATE),
        F.lit(2).alias("op_pasajeros_reservados"),
    )
    daily = daily.withColumns({bi.YEAR: F.year(bi.DATE), bi.MONTH: F.month(bi.DATE)})
    numbers = tables.settle(bi.number_flights(daily).coalesce(1), str(tmp_path / "n"))
    # At most one row per date and task that numbered flights, of 60,000.
    assert bi.summarise_bitmaps(daily, numbers).count() <= 30 * 8
    assert rows(bi.flights_by_month_bitmaps(bi.summarise_bitmaps(daily, numbers))) == rows(bi.flights_by_month(daily))
