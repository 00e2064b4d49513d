"""Rows that no key can match, told apart before a join so that they are not shuffled.

Keys are reduced to hash cells, which are broadcast: whole numbers, at most ``CELLS`` of
them however many keys there are. A row whose cell is not there has no partner. One whose
cell is there may have one, which the exact join that follows decides; so the number of
cells only decides how many rows that join shuffles, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hash cells. With a quarter as many keys, a fifth of the other rows passes for possible.
CELLS = 1 << 22
#: How many times larger than the keys the rows must be, as they are read twice.
TIMES = 16


def pays(spark: SparkSession, rows: int, keys: int) -> bool:
    """Whether to sift rows by keys, both in rows or both in bytes. A session that turns
    automatic broadcasts off gets none here."""
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return limit >= 0 and rows >= TIMES * keys


def _cell(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(CELLS)).cast("int")


def sift(df: DataFrame, key: str, keys: DataFrame, keys_key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``key`` may be among the keys, and those whose key is not; NULL is a
    key like any other. The rows are read once for each."""
    cells = F.broadcast(keys.select(_cell(F.col(keys_key)).alias("_cell")).distinct())
    same = _cell(df[key]) == F.col("_cell")
    return df.join(cells, same, "left_semi"), df.join(cells, same, "left_anti")
