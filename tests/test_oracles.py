"""Every registered query against its reference SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from skyledger.plans.oracles import ORACLES
from skyledger.plans.queries import QUERIES
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_reference_sql(spark, duck, name):
    assert differences(spark, duck, SF_DIR, name) == []


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "dim_anio" and df.count() > 0


# Tables with a third of the rows on one flight, on one day, and with many
# events at the same instant.
UNEVEN = {
    "lineitem": """SELECT * REPLACE (
        CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_suppkey % 3 = 0 THEN TIMESTAMP '1999-02-03' ELSE l_shipdate END AS l_shipdate)
      FROM lineitem""",
    "events": """SELECT * REPLACE (
        CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id,
        CASE WHEN event_id % 5 = 0 THEN TIMESTAMP '2024-01-30 10:00:00' ELSE ts END AS ts)
      FROM events""",
}


@pytest.fixture(scope="module")
def uneven(duck, tmp_path_factory):
    folder = tmp_path_factory.mktemp("uneven")
    for name, sql in UNEVEN.items():
        duck.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    [
        "gold_monthly",
        "latest_state",
        "latest_state_by_max",
        "latest_state_enriched",
        "latest_state_enriched_salted",
        "active_enriched",
        "active_enriched_salted",
        "bi_flights_month",
        "bi_flights_month_summary",
        "silver_partitioned",
        "gold_batches_replayed",
        "stream_current",
        "stream_current_compacted",
    ],
)
def test_uneven_tables(spark, uneven, name):
    assert differences(spark, connect(uneven), uneven, name) == []
