"""Frequent anchors, segments and windows that are joined apart."""

import pytest

from skyledger.llm import substring_dedup
from tests.llm.conftest import SMALL, supplied
from tests.oracle import connect, differences


@supplied(SMALL)
@pytest.mark.parametrize("hot_segments, heavy_rows", [(4096, 1), (1, 1), (1, 10)])
def test_heavy_keys(spark, monkeypatch, hot_segments, heavy_rows):
    monkeypatch.setattr(substring_dedup, "HOT_SEGMENTS", hot_segments)
    monkeypatch.setattr(substring_dedup, "HEAVY_ROWS", heavy_rows)
    monkeypatch.setattr(substring_dedup, "HEAVY_KEYS", 10**9)
    assert differences(spark, connect(SMALL), SMALL, "op4_repeated_passages") == []


def test_heavy_keys_are_few(spark):
    counts = spark.createDataFrame([(i, 1) for i in range(50)] + [(50, 900_000), (51, 200_000)], "k long, rows long")
    assert [r.k for r in substring_dedup._heavy(counts, "k").orderBy("k").collect()] == [50, 51]
    assert substring_dedup._heavy(counts.limit(0), "k").collect() == []
