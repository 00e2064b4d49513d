"""Generated events at a given rate, for trials of the streaming jobs under load."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from skyledger.sources import generators


def paced_bodies(
    spark: SparkSession, flights: DataFrame, rows_per_batch: int, **how
) -> DataFrame:
    """A stream of ``rows_per_batch`` messages in each micro-batch, of random flights.

    The source numbers its rows without gaps, and an event depends on its number and the
    seed only, so batches ``0`` to ``n - 1`` hold the events that ``generate_events``
    draws for ``n * rows_per_batch``, in any run and with any number of tasks.
    """
    numbers = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()
    return generators.one_event_each(numbers, "value", flights, **how)


def emit(
    spark: SparkSession,
    flights: DataFrame,
    path: str,
    rows_per_batch: int,
    batches: int,
    checkpoint: str,
    *,
    every: str = "0 seconds",
    **how,
) -> None:
    """Lands the first ``batches`` batches, one each ``every``, as folders of ``path``, and
    ends. A batch that is replayed replaces its folder; a run that was stopped goes on
    with the next batch."""
    full = threading.Event()

    def land(rows: DataFrame, batch_id: int) -> None:
        if batch_id < batches:
            rows.write.mode("overwrite").parquet(f"{path}/lote={batch_id}")
        if batch_id >= batches - 1:
            full.set()

    stream = paced_bodies(spark, flights, rows_per_batch, **how)
    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    query = writer.trigger(processingTime=every).start()
    try:
        while query.isActive and not full.wait(0.2):
            pass
        error = query.exception()
        if error:
            raise error
    finally:
        query.stop()
