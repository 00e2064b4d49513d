"""Uneven join keys: finding the heavy ones and spreading them."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A key is heavy when it would fill this many even shuffle partitions, with the
# share of the rows that means kept between the two bounds. At most 1/share keys
# can be heavy, so the lower bound also limits their number.
HEAVY_PARTITIONS = 2
SHARE_BOUNDS = (0.001, 0.05)
SKETCH_ITEMS = 10_000


@dataclass(frozen=True)
class HeavyKeys:
    """For each heavy key value, and for NULL, into how many parts to split it.

    Only the balance of work depends on these numbers; a join gives the same
    rows when they are stale, incomplete or empty.
    """

    parts: Mapping[str, int] = field(default_factory=dict)
    null_parts: int = 1

    def __bool__(self) -> bool:
        return bool(self.parts) or self.null_parts > 1

    def parts_of(self, key: Column) -> Column:
        """Number of parts of a row's key. Any other key costs one look into a hash
        set; heavy ones are told apart by their number of parts."""
        by_count: dict[int, list[str]] = {}
        for value, count in self.parts.items():
            by_count.setdefault(count, []).append(value)
        listed = F.lit(1)
        for count, values in by_count.items():
            listed = F.when(key.isin(values), count).otherwise(listed)
        if len(by_count) > 1:
            listed = F.when(key.isin(list(self.parts)), listed).otherwise(1)
        return F.when(key.isNull(), F.lit(self.null_parts)).otherwise(listed)


def aqe_splits_skew(spark: SparkSession) -> bool:
    """Whether the session splits oversized join partitions at run time."""
    return all(
        spark.conf.get(key, "true").lower() == "true"
        for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


def size_of(df: DataFrame) -> int:
    """Bytes that Spark's own size check takes a frame for."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_by_size(df: DataFrame) -> bool:
    """Whether Spark's own size check will broadcast this side of a join."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size_of(df) <= limit


def heavy_keys(
    df: DataFrame, key: str, *, share: float | None = None, partitions: int | None = None
) -> HeavyKeys:
    """Keys that hold at least ``share`` of the rows, each to be split into as
    many parts as it would fill of ``partitions`` even shuffle partitions.

    One scan of one column with a mergeable heavy-hitter sketch: tasks send a
    sketch each, no key is shuffled, and the driver gets at most 1/share values.
    """
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if share is None:
        low, high = SHARE_BOUNDS
        share = min(high, max(low, HEAVY_PARTITIONS / partitions))
    limit = int(1 / share)
    report = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(key).alias("present"),
        F.expr(f"approx_top_k(`{key}`, {limit}, {SKETCH_ITEMS})").alias("top"),
    ).first()
    rows, floor = report["rows"], max(1, share * report["rows"])

    def parts(count: int) -> int:
        return max(2, math.ceil(count / rows * partitions))

    missing = rows - report["present"]
    return HeavyKeys(
        {
            top["item"]: parts(top["count"])
            for top in report["top"] or ()
            if top["item"] is not None and top["count"] >= floor
        },
        parts(missing) if missing >= floor else 1,
    )


def scatter(df: DataFrame, key: str, heavy: HeavyKeys, salt: str) -> DataFrame:
    """Salt for the side that is split: a row of a heavy key gets one of its
    parts, any other row part 0.

    The part is a hash of the row's place in its file, so equal rows are spread
    too, and a task that runs again after an executor is lost assigns the same
    one. A frame that is not read from Parquet files has no such place; there it
    is a hash of the whole row, which leaves equal rows together.
    """
    parts = heavy.parts_of(F.col(key))
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    try:
        return df.withColumn(salt, F.pmod(place, parts).cast("int"))
    except AnalysisException:
        return df.withColumn(salt, F.pmod(F.xxhash64(*df.columns), parts).cast("int"))


def replicate(df: DataFrame, key: str, heavy: HeavyKeys, salt: str) -> DataFrame:
    """Salt for the other side, which has one row per key: the row of a heavy
    key is repeated for each part, every other row stays single."""
    last = heavy.parts_of(F.col(key)) - 1
    return df.withColumn(salt, F.explode(F.sequence(F.lit(0), last)))
