import dataclasses

import pytest

from skyledger.config import LakeConfig
from skyledger.operators.bronze import rename_flights
from skyledger.operators.gold import monthly_by_route
from skyledger.operators.silver import silver_flights
from skyledger.plans import batch
from skyledger.schemas import BRONZE_NAMES, SILVER_ADDED
from skyledger.sources import csv_files, generators, tables
from tests.data import rows


@pytest.fixture
def csv_path(spark, tmp_path):
    path = str(tmp_path / "in")
    csv_files.write_flights(generators.generate_flights(spark, 800), path)
    return path


def test_chain(spark, lake, csv_path):
    bad_cells = batch.run(spark, lake, csv_path)
    assert set(bad_cells.values()) == {0}
    bronze = tables.read_table(spark, lake.table_name("bronze"))
    assert bronze.columns == [*BRONZE_NAMES.values(), "ingestion_date"]
    assert bronze.select("ingestion_date").distinct().count() == 1
    silver = tables.read_table(spark, lake.table_name("silver"))
    assert silver.columns == [*bronze.columns, *SILVER_ADDED]
    expected = monthly_by_route(silver_flights(rename_flights(csv_files.read_flights(spark, csv_path))))
    assert rows(tables.read_table(spark, lake.table_name("gold"))) == rows(expected)


def test_chain_run_again_gives_the_same_tables(spark, lake, csv_path):
    batch.run(spark, lake, csv_path)
    first = rows(tables.read_table(spark, lake.table_name("gold")))
    batch.run(spark, lake, csv_path)
    assert rows(tables.read_table(spark, lake.table_name("gold"))) == first


def test_a_failing_step_stops_the_chain(spark, lake, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        batch.run(spark, lake, str(tmp_path / "missing"))
    assert not spark.catalog.tableExists(lake.table_name("silver"))


def test_silver_can_be_partitioned(spark, lake, csv_path):
    cfg = dataclasses.replace(lake, silver_partitions=("analisis_anio", "analisis_mes"))
    batch.run(spark, cfg, csv_path)
    parts = spark.sql(f"SHOW PARTITIONS {cfg.table_name('silver')}").count()
    assert 12 <= parts <= 13
    gold = rows(tables.read_table(spark, cfg.table_name("gold")))
    batch.run(spark, lake, csv_path)
    assert rows(tables.read_table(spark, lake.table_name("gold"))) == gold


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "a")], "n int not null, t string")
    assert batch.schema_report(df) == [("n", "int", False), ("t", "string", True)]


def test_config_from_session(spark, conf):
    conf(spark__skyledger__catalog="prod", spark__skyledger__silver_partitions="a,b")
    cfg = LakeConfig.from_session(spark, table="vuelos2")
    assert (cfg.catalog, cfg.silver_partitions, cfg.table) == ("prod", ("a", "b"), "vuelos2")
    assert cfg.table_format == "parquet"
