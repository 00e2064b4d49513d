import pytest
from pyspark.sql import functions as F

from skyledger.config import LakeConfig
from skyledger.plans import batch
from skyledger.sources import tables
from tests.data import rows


def numbers(spark, *values):
    return spark.createDataFrame([(v, f"v{v}") for v in values], "n int, t string")


def test_names(spark):
    flat = LakeConfig(root="/data/")
    assert flat.table_name("gold") == "dev_gold.vuelos"
    assert flat.table_name("gold", stream=True, table="x") == "streaming_gold.x"
    assert flat.location("gold", stream=True) == "/data/streaming/gold"
    assert flat.checkpoint("c") == "/data/checkpoints/c"
    assert LakeConfig(three_part_names=True).table_name("silver") == "dev.silver.vuelos"
    assert LakeConfig().location("gold") is None
    with pytest.raises(ValueError):
        LakeConfig().checkpoint("c")


def test_schemas_are_created_at_their_locations_and_again(spark, lake):
    names = tables.create_schemas(spark, lake)
    assert len(names) == 7 and lake.schema("exploratory") in names
    info = spark.sql(f"DESCRIBE SCHEMA {lake.schema('gold')}").collect()
    assert any(lake.location("gold") in str(r[1]) for r in info)


def test_overwrite_replaces_rows_and_schema(spark, lake):
    name = lake.table_name("bronze")
    tables.overwrite_table(numbers(spark, 1, 2), name)
    tables.overwrite_table(numbers(spark, 3).select("n"), name)
    assert rows(tables.read_table(spark, name)) == [(3,)]


def failing(spark):
    return numbers(spark, 1, 2).select("n", F.raise_error(F.col("t")).cast("string").alias("t"))


def test_a_failed_overwrite_leaves_the_old_rows(spark, lake):
    name = lake.table_name("bronze")
    tables.overwrite_table(numbers(spark, 1, 2), name)
    with pytest.raises(Exception, match="v1|v2"):
        tables.overwrite_table(failing(spark), name)
    assert rows(tables.read_table(spark, name)) == [(1, "v1"), (2, "v2")]
    left = spark.catalog.listTables(name.split(".")[0])
    assert [t.name for t in left if not t.isTemporary] == [name.split(".")[1]]


def test_a_failed_replay_leaves_the_batch(spark, lake):
    name = lake.table_name("gold", stream=True)
    tables.write_batch(numbers(spark, 1, 2), name, 0)
    with pytest.raises(Exception, match="v1|v2"):
        tables.write_batch(failing(spark), name, 0)
    assert rows(spark.table(name).select("n", "t")) == [(1, "v1"), (2, "v2")]


def test_a_new_column_is_added_and_a_missing_one_refused(spark, lake):
    name = lake.table_name("gold", stream=True)
    tables.write_batch(numbers(spark, 1), name, 0)
    tables.write_batch(numbers(spark, 2).withColumn("extra", F.lit(5)), name, 1)
    stored = spark.table(name).select("n", "t", "extra", "batch_id")
    assert {tuple(r) for r in stored.collect()} == {(1, "v1", None, 0), (2, "v2", 5, 1)}
    with pytest.raises(Exception, match="extra"):
        tables.write_batch(numbers(spark, 3), name, 2)


def test_partitioned_overwrite_prunes_on_reading(spark, lake):
    name = lake.table_name("silver")
    tables.overwrite_table(numbers(spark, 1, 2, 3), name, partition_by=["n"])
    one = tables.read_table(spark, name).where("n = 2")
    assert rows(one) == [(2, "v2")]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(n" in plan


def test_a_replayed_batch_replaces_itself_and_nothing_else(spark, lake):
    name = lake.table_name("gold", stream=True)
    tables.write_batch(numbers(spark, 1, 2), name, 0)
    tables.write_batch(numbers(spark, 3), name, 1)
    tables.write_batch(numbers(spark, 4, 5).select("t", "n"), name, 1)
    stored = {(r.n, r.t, r.batch_id) for r in spark.table(name).collect()}
    assert stored == {(1, "v1", 0), (2, "v2", 0), (4, "v4", 1), (5, "v5", 1)}
    assert tables.batch_ids(spark, name) == [0, 1]
    assert not [v for v in spark.catalog.listTables() if v.name.startswith("batch_")]
    tables.drop_batches(spark, name, [0])
    assert {r.batch_id for r in spark.table(name).collect()} == {1}


def test_settled_result_has_its_real_size(spark, tmp_path):
    wide = spark.range(100_000).select((F.col("id") % 3).alias("k")).distinct()
    small = tables.settle(wide, str(tmp_path / "s"))
    assert sorted(r.k for r in small.collect()) == [0, 1, 2]
    size = int(str(small._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size < 100_000


def test_teardown_removes_listed_tables_and_paths(spark, lake):
    kept, gone = lake.table_name("bronze"), lake.table_name("silver")
    for name in (kept, gone):
        tables.overwrite_table(numbers(spark, 1), name)
    checkpoint = lake.checkpoint("x")
    numbers(spark, 1).write.parquet(checkpoint)
    removed = batch.teardown(
        spark, lake, tables_to_drop=[gone, f"{gone}_never_there"], paths=[checkpoint, f"{lake.root}/none"]
    )
    assert removed == [checkpoint]
    assert spark.catalog.tableExists(kept) and not spark.catalog.tableExists(gone)


def test_paths_outside_the_root_are_refused(spark, lake, tmp_path):
    other = tmp_path / "other"
    other.mkdir()
    for path in (str(other), lake.root, f"{lake.root}/../other", f"{lake.root}x"):
        with pytest.raises(ValueError):
            tables.delete_paths(spark, [path], root=lake.root)
    assert other.exists()
    with pytest.raises(ValueError):
        batch.teardown(spark, LakeConfig(), tables_to_drop=[], paths=["/tmp/none"])


def test_dropping_a_schema_needs_its_name(spark, lake):
    schema = lake.schema("bronze")
    tables.overwrite_table(numbers(spark, 1), lake.table_name("bronze"))
    with pytest.raises(ValueError):
        tables.drop_schema(spark, schema, confirm="yes")
    tables.drop_schema(spark, schema, confirm=schema)
    assert not spark.catalog.databaseExists(schema)
