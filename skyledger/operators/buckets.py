"""The history in parts by a hash of the flight id, so that a join with few flights reads
few of them.

The part is a partition column whose name says how many parts there are, so a stored
table tells by itself how it was cut. It is derived and belongs to no data model: what is
read through ``without`` has it no more.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NAME = re.compile(r"cubeta_vuelo_(\d+)")


def bucket(flight: Column, parts: int) -> Column:
    """Part of a flight id; NULL ids share one."""
    return F.pmod(F.xxhash64(flight), F.lit(parts)).cast("int")


def column(parts: int) -> str:
    return f"cubeta_vuelo_{int(parts)}"


def add(df: DataFrame, parts: int, flight: str = "id_vuelo") -> DataFrame:
    return df.withColumn(column(parts), bucket(F.col(flight), parts))


def parts_of(df: DataFrame) -> int:
    """Number of parts of a table that is stored in such, else 0."""
    return next((int(m[1]) for m in map(_NAME.fullmatch, df.columns) if m), 0)


def without(df: DataFrame) -> DataFrame:
    parts = parts_of(df)
    return df.drop(column(parts)) if parts else df


def holding(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The parts of a stored table in which the keys' flights lie, all of it where it is
    not in parts. What comes to the driver is at most one number for each part; with
    them the scan skips the other partitions before it is planned."""
    parts = parts_of(df)
    if not parts:
        return df
    found = keys.select(bucket(F.col(key), parts).alias("b")).distinct().collect()
    return df.where(F.col(column(parts)).isin([row.b for row in found]) if found else F.lit(False))
