import pytest
from pyspark.sql import functions as F

from skyledger.operators import enrich
from skyledger.operators import tracking as tk
from skyledger.operators.silver import silver_flights
from skyledger.operators.skew import HeavyKeys, aqe_splits_skew, heavy_keys, scatter
from skyledger.schemas import TRACKING_COLUMNS
from skyledger.sources.tables import settle
from tests.data import bronze, events, rows


@pytest.fixture
def sides(spark):
    flights = [{"ID_Vuelo": "HOT", "Distancia_KM": n, "Pasajeros_Reservados": n % 7} for n in range(60)]
    flights += [{"ID_Vuelo": None, "Distancia_KM": n} for n in range(50)]
    flights += [{"ID_Vuelo": f"AA{n}"} for n in range(20)]
    flights += [{"ID_Vuelo": "TWICE"}] * 2
    history = silver_flights(bronze(spark, *flights))
    ids = ["HOT", "AA3", "AA4", "TWICE", "NEW1", "NEW2"]
    latest = tk.latest_state(events(spark, *({"ID_Vuelo": i} for i in ids)))
    return history, latest


def test_history_side_keeps_every_flight_and_repeats_states(sides):
    history, latest = sides
    joined = enrich.flights_with_state(history, latest)
    assert joined.columns == [*history.columns, *TRACKING_COLUMNS]
    assert joined.count() == history.count()
    known = joined.where("estado_actual_normalizado is not null")
    assert {r.id_vuelo: r["count"] for r in known.groupBy("id_vuelo").count().collect()} == {
        "HOT": 60, "AA3": 1, "AA4": 1, "TWICE": 2,
    }


def test_active_side_equals_a_left_join_from_the_states(sides):
    history, latest = sides
    joined = enrich.active_with_history(history, latest)
    plain = (
        latest.join(history, latest.tracking_key == history.id_vuelo, "left")
        .drop("id_vuelo")
        .withColumnRenamed("tracking_key", "id_vuelo")
    )
    assert rows(joined) == rows(plain)
    assert {"NEW1", "NEW2"} <= {r.id_vuelo for r in joined.select("id_vuelo").collect()}


@pytest.mark.parametrize("combine", [enrich.flights_with_state, enrich.active_with_history])
@pytest.mark.parametrize(
    "heavy",
    [
        HeavyKeys({"HOT": 5}, null_parts=4),
        HeavyKeys({"HOT": 3, "NEW1": 2, "GONE": 7}),
        HeavyKeys(null_parts=9),
        HeavyKeys(),
    ],
)
def test_salting_never_changes_the_result(sides, combine, heavy, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    history, latest = sides
    assert rows(combine(history, latest, heavy)) == rows(combine(history, latest))


def test_heavy_keys_are_found(sides):
    history, _ = sides
    found = heavy_keys(history, "id_vuelo", share=0.2, partitions=1000)
    assert (found.parts, found.null_parts) == ({"HOT": 455}, 379)
    assert heavy_keys(history, "id_vuelo", partitions=4).parts == {"HOT": 2}
    assert not heavy_keys(history.where("id_vuelo like 'AA%'"), "id_vuelo", share=0.2)
    assert not heavy_keys(history.where("false"), "id_vuelo")


def test_the_share_that_counts_as_heavy_follows_the_partitions(spark):
    df = spark.range(100_000).selectExpr("if(id % 250 = 0, 'A', concat('k', id)) as k")
    assert heavy_keys(df, "k", partitions=100).parts == {}
    assert heavy_keys(df, "k", partitions=2000).parts == {"A": 8}


def test_salt_spreads_the_heavy_key(sides, conf):
    history, _ = sides
    salted = scatter(history, "id_vuelo", HeavyKeys({"HOT": 8}), "salt")
    by_salt = salted.where("id_vuelo = 'HOT'").groupBy("salt").count().collect()
    assert len(by_salt) >= 6
    assert salted.where("id_vuelo like 'AA%' and salt <> 0").count() == 0


def test_salt_is_used_only_without_adaptive_splitting(sides, spark, conf):
    history, latest = sides
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert aqe_splits_skew(spark) and enrich.skew_plan(history, latest) is None
    conf(spark__sql__adaptive__enabled="false")
    assert "HOT" in enrich.skew_plan(history, latest).parts


def test_no_salt_and_no_scan_when_the_states_are_broadcast(sides, tmp_path, conf):
    history, latest = sides
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="10MB")
    assert enrich.skew_plan(history, settle(latest, str(tmp_path / "latest"))) is None


def test_salt_spreads_equal_rows_of_files(spark, tmp_path):
    path = str(tmp_path / "equal")
    spark.range(1000).selectExpr("'HOT' as id_vuelo", "1 as n").coalesce(2).write.parquet(path)
    stored = spark.read.parquet(path).where("n = 1").withColumn("m", F.lit(2))
    salted = scatter(stored, "id_vuelo", HeavyKeys({"HOT": 16}), "salt")
    sizes = [r["count"] for r in salted.groupBy("salt").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * min(sizes) + 20
    assert salted.columns == ["id_vuelo", "n", "m", "salt"]
    assert rows(salted) == rows(scatter(stored, "id_vuelo", HeavyKeys({"HOT": 16}), "salt"))


def test_salted_join_is_shuffled_by_key_and_salt(sides, tmp_path):
    history, latest = sides
    latest = settle(latest, str(tmp_path / "latest"))
    joined = enrich.flights_with_state(history, latest, HeavyKeys({"HOT": 5}))
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert "_salt" in text.split("Exchange hashpartitioning(", 1)[1].split(")")[0]


def test_adaptive_execution_splits_a_dominating_flight(spark, conf):
    """A sort-merge join with a third of the history on one id."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__shuffle__partitions="16",
    )
    history = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('AA', id)) as id_vuelo", "sha2(string(id), 256) as pad"
    )
    latest = spark.range(0, 60_000, 1, 4).selectExpr(
        "if(id = 0, 'HOT', concat('AA', id)) as tracking_key", "id as n"
    )
    joined = enrich.flights_with_state(history, latest)
    assert len(joined.collect()) == 60_000
    assert "skewed" in joined._jdf.queryExecution().executedPlan().toString()
    counts = joined.selectExpr("count(*)", "count(n)", "count(pad)").first()
    assert tuple(counts) == (60_000, 60_000, 60_000)
