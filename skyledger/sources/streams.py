"""Unbounded inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from skyledger.schemas import EVENT_ENVELOPE


def read_events(
    spark: SparkSession,
    fmt: str = "parquet",
    *,
    path: str | None = None,
    schema: StructType | None = None,
    **options: str,
) -> DataFrame:
    """Event stream with the payload in ``body``.

    Any streaming source fits: its options pass through. File sources need a
    schema and get the event envelope if none is given; brokers (``eventhubs``,
    ``kafka``) bring their own. Kafka calls the payload ``value``, which is
    renamed here.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if path is not None:
        return reader.schema(schema or EVENT_ENVELOPE).load(path)
    events = reader.load()
    if "body" not in events.columns and "value" in events.columns:
        events = events.withColumnRenamed("value", "body")
    return events


def follow_table(spark: SparkSession, name: str, **options: str) -> DataFrame:
    """Rows of a table as they are appended."""
    return spark.readStream.options(**options).table(name)
