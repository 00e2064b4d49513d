"""What each micro-batch of a stream says of itself, stored as a table.

The counts are taken by an observation while the batch is written, so no row is read
twice, and are stored by a listener as the batch of a table with the same number: a batch
that is replayed replaces its counts too.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from skyledger.operators import tracking as tk
from skyledger.schemas import TRACKING_EVENT
from skyledger.sources import tables

#: Columns of a table of counts: rows, those that yield no field, and per field its NULLs.
ROWS, REJECTED, MISSING = "filas", "rechazadas", "sin_{}"


def observed(events: DataFrame, label: str) -> DataFrame:
    """Parsed events that are counted as they pass."""
    fields = TRACKING_EVENT.fieldNames()
    nothing = F.coalesce(*(F.col(name).cast("string") for name in fields)).isNull()
    return events.observe(
        label,
        F.count(F.lit(1)).alias(ROWS),
        F.count_if(nothing).alias(REJECTED),
        *(F.count_if(F.col(name).isNull()).alias(MISSING.format(name.lower())) for name in fields),
    )


class BatchCounts(StreamingQueryListener):
    """Stores the observation ``label`` of every batch in a table, by batch number."""

    def __init__(self, spark: SparkSession, label: str, table: str, fmt: str = "parquet"):
        self.spark, self.label, self.table, self.fmt = spark, label, table, fmt
        self.run_ids: set[str] = set()
        self.ended = threading.Condition()
        self.error: Exception | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.label)
        if row is None:
            return
        try:
            counts = row.asDict()
            schema = ", ".join(f"{name} long" for name in counts)
            told = self.spark.createDataFrame([tuple(counts.values())], schema)
            told = told.withColumn("hora", F.lit(progress.timestamp).cast("timestamp"))
            tables.write_batch(told, self.table, progress.batchId, self.fmt)
        except Exception as error:  # a listener's errors are only logged; keep it for the waiting job
            self.error = error

    def onQueryTerminated(self, event) -> None:
        with self.ended:
            self.run_ids.add(str(event.runId))
            self.ended.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the query has ended and its counts are stored."""
        query.awaitTermination()
        with self.ended:
            if not self.ended.wait_for(lambda: str(query.runId) in self.run_ids, seconds):
                raise TimeoutError(f"no end of query {query.runId} was reported")
        if self.error:
            raise self.error


def start_counted_silver(
    bronze: DataFrame, table: str, counts: str, checkpoint: str, start, *, fmt: str = "parquet", **how
) -> tuple[StreamingQuery, BatchCounts]:
    """``start`` (which appends a stream to a table) on the parsed events, with their counts
    stored beside them. Remove the listener when the query is not needed any more."""
    spark = bronze.sparkSession
    label = counts.replace(".", "_")
    listener = BatchCounts(spark, label, counts, fmt)
    spark.streams.addListener(listener)
    query = start(observed(tk.parse_events(bronze), label), table, checkpoint, fmt=fmt, **how)
    return query, listener
