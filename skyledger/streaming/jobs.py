"""The streaming jobs: raw copy, parsed events, joined states, current state.

Each ``start_*`` returns the running query. With no ``every`` a job takes what
is available and ends; with one (``"30 seconds"``) it runs until stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from skyledger.config import Horizon, LakeConfig, Rules
from skyledger.functions import tracking as tr
from skyledger.operators import bi, enrich, sieve
from skyledger.operators import tracking as tk
from skyledger.operators.skew import broadcast_by_size
from skyledger.schemas import TRACKING_COLUMNS, TRACKING_EVENT, TRACKING_KEY
from skyledger.sources import tables
from skyledger.sources.streams import follow_table

SIDES = {"history": enrich.flights_with_state, "active": enrich.active_with_history}

#: Column that says which load of the history a joined row comes from.
HISTORY_VERSION = "version_historia"


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_append(
    stream: DataFrame, table: str, checkpoint: str, *, fmt: str = "parquet", every: str | None = None
) -> StreamingQuery:
    """Appends a stream to a table. Rows and progress commit together, so a
    restart neither loses nor repeats any."""
    writer = (
        stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, every).toTable(table)


def start_bronze(events: DataFrame, table: str, checkpoint: str, **how) -> StreamingQuery:
    """Raw copy with every column of the connector."""
    return start_append(events, table, checkpoint, **how)


def start_silver(bronze: DataFrame, table: str, checkpoint: str, **how) -> StreamingQuery:
    """Parsed events, unfiltered."""
    return start_append(tk.parse_events(bronze), table, checkpoint, **how)


def start_rejects(bronze: DataFrame, table: str, checkpoint: str, **how) -> StreamingQuery:
    """Side table of the raw events that could not be read."""
    return start_append(tk.unreadable_events(bronze), table, checkpoint, **how)


def _start_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None,
) -> StreamingQuery:
    writer = (
        stream.writeStream.foreachBatch(handle)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, every).start()


def states_table(table: str) -> str:
    """Name of the table with the states that a joined table was made from."""
    return f"{table}_estados"


def gold_batch_writer(
    history: str,
    table: str,
    staging: str,
    *,
    rules: Rules = Rules(),
    side: str = "history",
    fmt: str = "parquet",
) -> Callable[[DataFrame, int], None]:
    """Function that joins one micro-batch of events with the history and
    writes the result as that batch's partition.

    Each batch takes the load of the history that is live when it begins, so later loads
    are seen, also those of another application, and one that comes during a batch does
    not disturb it. Its rows carry the name of that load. The states themselves are kept
    as batches of a table beside it, also those of flights that the history lacks yet.
    The batch's states are settled in ``staging`` first (overwritten by the
    next batch): the events are parsed once, and the join is planned with the
    real number of states. ``side="history"`` writes every historical flight in
    every batch; where only tracked flights are wanted, ``side="active"``
    writes those alone.
    """
    combine = SIDES[side]
    if side == "active":
        combine = partial(combine, staging=f"{staging}_matched")

    def write(events: DataFrame, batch_id: int) -> None:
        if events.isEmpty():
            return
        version, flights = tables.snapshot(events.sparkSession, history)
        latest = tables.settle(tk.latest_state(events, rules), staging)
        joined = combine(flights, latest, enrich.skew_plan(flights, latest))
        joined = joined.withColumn(HISTORY_VERSION, F.lit(version))
        tables.write_batch(latest, states_table(table), batch_id, fmt)
        tables.write_batch(joined, table, batch_id, fmt)

    return write


def start_gold(
    bronze: DataFrame,
    history: str,
    table: str,
    checkpoint: str,
    *,
    rules: Rules = Rules(),
    side: str = "history",
    fmt: str = "parquet",
    every: str | None = None,
) -> StreamingQuery:
    """Per micro-batch: clean, latest state per flight, join, append.

    Window functions and a join with a static left side are not allowed on a
    stream itself, hence ``foreachBatch``.
    """
    staging = f"{checkpoint.rstrip('/')}_latest"
    write = gold_batch_writer(history, table, staging, rules=rules, side=side, fmt=fmt)
    return _start_batches(tk.parse_events(bronze), write, checkpoint, every)


def clock_table(table: str) -> str:
    """Name of the table with one row per batch of a log with a horizon: newest event
    time so far, events, and how many of them came too late."""
    return f"{table}_reloj"


def _clock(spark: SparkSession, table: str, before: int | None = None) -> int | None:
    """Newest event time of the batches (before one of them), in microseconds."""
    if not spark.catalog.tableExists(clock_table(table)):
        return None
    batches = spark.table(clock_table(table))
    if before is not None:
        batches = batches.where(F.col(tables.BATCH_ID) < before)
    return batches.agg(F.max("hasta")).first()[0]


def current_batch_writer(
    table: str, *, stateful: bool = False, fmt: str = "parquet", horizon: Horizon | None = None
) -> Callable[[DataFrame, int], None]:
    """Function that adds a micro-batch of clean events to the log of current states.

    With a ``horizon``, late events are left out and counted; the counts, and the clock
    that later batches go by, are kept beside the log. What is late depends on earlier
    batches only, so a replay takes the same events.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        if horizon is None:
            tables.write_batch(rows if stateful else tk.latest_per_key(rows), table, batch_id, fmt)
            return
        late = tr.is_late(F.col(tk.TIME), _clock(rows.sparkSession, table, batch_id), horizon)
        seen = Observation()
        counted = rows.observe(
            seen,
            F.max(F.unix_micros(tk.TIME)).alias("hasta"),
            F.count(F.lit(1)).alias("eventos"),
            F.count_if(late).alias("tardios"),
        )
        tables.write_batch(tk.latest_per_key(counted.where(~late)), table, batch_id, fmt)
        told = rows.sparkSession.createDataFrame(
            [(seen.get["hasta"], seen.get["eventos"], seen.get["tardios"])],
            "hasta long, eventos long, tardios long",
        )
        tables.write_batch(told, clock_table(table), batch_id, fmt)

    return write


def start_current(
    bronze: DataFrame,
    table: str,
    checkpoint: str,
    *,
    stateful: bool = False,
    fmt: str = "parquet",
    every: str | None = None,
    horizon: Horizon | None = None,
) -> StreamingQuery:
    """Latest event of each flight across batches, as a log by batch.

    Every batch writes one row per flight it touched. ``stateful=True`` keeps
    one state row per flight, so what a batch writes is the latest of all
    events so far. ``stateful=False`` writes the latest of the batch and leaves
    the merge to ``read_current``: no state store, no fixed number of state
    partitions, same answer when read. A ``horizon`` lets flights leave the log, which
    ``compact_current`` then keeps to the flights still flying and those just finished.
    """
    if stateful and horizon:
        raise ValueError("a horizon needs the log: the state store keeps every flight")
    events = tk.clean_events(tk.parse_events(bronze))
    write = current_batch_writer(table, stateful=stateful, fmt=fmt, horizon=horizon)
    return _start_batches(tk.latest_by_max(events) if stateful else events, write, checkpoint, every)


CURRENT_TABLE = "estado_actual"
REJECTS_TABLE = "rechazados"
COUNTS_TABLE = "conteos"


def start_all(
    spark: SparkSession,
    cfg: LakeConfig,
    events: DataFrame,
    *,
    side: str = "active",
    every: str | None = None,
    follow: Mapping[str, str] | None = None,
) -> list[StreamingQuery]:
    """The whole topology: bronze, and from it silver, rejects, gold and the
    current state, each with a checkpoint of its own.

    Without ``every``, bronze is completed before the others start, so that one
    call carries what is available through to the end. ``follow`` holds the
    reading options of the jobs behind bronze, such as ``maxFilesPerTrigger``,
    which bounds the batch they take after a pause.
    """
    how = {"fmt": cfg.table_format, "every": every}

    def table(layer: str, name: str | None = None) -> str:
        return cfg.table_name(layer, stream=True, table=name)

    bronze = start_bronze(events, table("bronze"), cfg.checkpoint("bronze"), **how)
    if every is None:
        bronze.awaitTermination()

    def raw() -> DataFrame:
        return follow_table(spark, table("bronze"), **(follow or {}))

    return [
        bronze,
        start_silver(raw(), table("silver"), cfg.checkpoint("silver"), **how),
        start_rejects(raw(), table("silver", REJECTS_TABLE), cfg.checkpoint("rejects"), **how),
        start_gold(
            raw(),
            cfg.table_name("silver"),
            table("gold"),
            cfg.checkpoint("gold"),
            rules=cfg.rules,
            side=side,
            **how,
        ),
        start_current(
            raw(), table("gold", CURRENT_TABLE), cfg.checkpoint("current"), stateful=False, **how
        ),
    ]


def _standing(log: DataFrame, table: str, horizon: Horizon | None) -> DataFrame:
    """Newest event of each flight in the rows of a log, less those that have left."""
    newest = log.select(*TRACKING_EVENT.fieldNames()).transform(tk.latest_per_key)
    clock = _clock(log.sparkSession, table) if horizon else None
    if clock is None:
        return newest
    return newest.where(~tr.is_over(F.coalesce("Estado_Actual", F.lit("")), F.col(tk.TIME), clock, horizon))


def read_current(
    spark: SparkSession, table: str, rules: Rules = Rules(), horizon: Horizon | None = None
) -> DataFrame:
    """Latest state per flight from the log, without the flights that have left.

    The newest event wins whichever batch wrote it, so late batches, replayed
    batches and compacted copies cannot change the answer.
    """
    return _standing(spark.table(table), table, horizon).transform(tk.tracking_view, rules)


def _newest_states(spark: SparkSession, table: str) -> DataFrame:
    """The newest state of each flight; of equally new ones that of the later batch."""
    time, rest = TRACKING_COLUMNS[0], TRACKING_COLUMNS[1:]
    newest = F.max(F.struct(time, tables.BATCH_ID, *rest)).alias("newest")
    states = spark.table(states_table(table)).groupBy(TRACKING_KEY).agg(newest)
    return states.select(TRACKING_KEY, *(F.col(f"newest.{c}").alias(c) for c in TRACKING_COLUMNS))


def _states_of(spark: SparkSession, table: str, batches: list[int]) -> DataFrame | None:
    """The states that these batches of a joined table were made from, None if some are not kept."""
    if not spark.catalog.tableExists(states_table(table)):
        return None
    states = spark.table(states_table(table)).where(F.col(tables.BATCH_ID).isin(batches))
    kept = states.select(tables.BATCH_ID).distinct().count()
    return states if kept == len(batches) else None


def read_gold(
    spark: SparkSession, table: str, history: str | None = None, *, side: str = "history"
) -> DataFrame:
    """Current rows of the batch-wise joined table, all of one load of the history.

    Every batch adds rows for the flights it touched (with ``side="history"``, for
    all flights). Of each flight id, the rows of one batch are current: the one
    with the newest event, the last one where events are equally new or missing.
    Which batch that is, the states kept beside the table tell; where they lack a batch, its
    rows with an event do. A flight without any event is in every batch that wrote all flights
    of the load, so its current row is in the last of these, where it passes without a
    shuffle (see ``sieve``). So a row is read once to find the loads and once, if it has an
    event or is of that batch, for the result. Where the version does not name a
    load, batches may hold different flights, and all rows are compared.

    Where the history was loaded again between the batches, the states are joined with
    the load that is live now, for which ``history`` and ``side`` must be given.
    ``merge_gold`` stores the result, so that a reader scans no batches at all.
    """
    stored = spark.table(table)
    seen = F.col("tracking_timestamp_evento").isNotNull()
    counts = (F.count(F.lit(1)).alias("rows"), F.count_if(seen).alias("seen"))
    batches = stored.groupBy(HISTORY_VERSION, tables.BATCH_ID).agg(*counts).collect()
    loads = {batch[HISTORY_VERSION] for batch in batches}
    if len(loads) > 1:
        if history is None:
            raise ValueError(f"{table} holds several loads of the history: name its table")
        return SIDES[side](tables.snapshot(spark, history)[1], _newest_states(spark, table))
    of_one_load = bool(loads) and tables.is_load(loads.pop() or "")
    tracked = stored.where(seen) if of_one_load else stored
    states = _states_of(spark, table, [b[tables.BATCH_ID] for b in batches]) if of_one_load else None
    told, flight = (tracked, enrich.FLIGHT) if states is None else (states.where(seen), TRACKING_KEY)
    time, batch = F.col("tracking_timestamp_evento").alias("_t"), F.col(tables.BATCH_ID).alias("_in")
    flights = told.select(F.col(flight).alias("_id"), time, batch)
    current = flights.groupBy("_id").agg(F.max(F.struct("_t", "_in"))["_in"].alias("_b"))
    same = tracked[enrich.FLIGHT].eqNullSafe(F.col("_id")) & (tracked[tables.BATCH_ID] == F.col("_b"))
    rows = tracked.join(current, same, "left_semi")
    without = [b for b in batches if b["rows"] > b["seen"]]
    if of_one_load and without:
        last = max(b[tables.BATCH_ID] for b in without)
        unseen, known = stored.where(~seen & (F.col(tables.BATCH_ID) == last)), flights.select("_id")
        some = sum(b["rows"] for b in batches), sum(b["seen"] for b in batches)
        if not broadcast_by_size(known) and sieve.pays(spark, *some):
            unseen, never = sieve.sift(unseen, enrich.FLIGHT, known, "_id")
            rows = rows.unionByName(never)
        rows = rows.unionByName(
            unseen.join(known.distinct(), F.col(enrich.FLIGHT) == F.col("_id"), "left_anti")
        )
    return rows.drop(tables.BATCH_ID, HISTORY_VERSION)


#: Table with the current rows of the joined table, which the dashboard reads.
MERGED_TABLE = "vuelos_actual"


def merge_gold(
    spark: SparkSession,
    history: str,
    table: str,
    merged: str,
    staging: str,
    *,
    side: str = "history",
    fmt: str = "parquet",
    grace_seconds: float = tables.GRACE_SECONDS,
) -> int:
    """Merges the batches of the joined table into a table of current rows, which is
    replaced in one step; returns how many batches were taken.

    While the history is the one the merged table was made from, only the flights with
    new events are joined again and the other rows are copied. After a load of the
    history all rows are joined with it, so the merged rows are always of one load.
    Then the batches go, but for the newest, which may be replayed, and their states
    become one batch: neither table grows with the number of batches ever written. A run
    that stops anywhere, or merges a batch twice, gives the same rows.

    What is not live any more is kept ``grace_seconds`` for running readers. With 0 there are
    none, so the merged batches, which the states can make again, go before the new rows are
    written and the old ones right after: the disk never holds both batches and merge.
    """
    states = states_table(table)
    if not spark.catalog.tableExists(states):
        return 0
    batches = [b for b in tables.batch_ids(spark, states) if b >= 0]
    version, flights = tables.snapshot(spark, history)
    newest = tables.settle(_newest_states(spark, table), f"{staging}_states")
    before = tables.snapshot(spark, merged)[1] if spark.catalog.tableExists(merged) else None
    held = before.select(HISTORY_VERSION).first() if before is not None else None
    if held is not None and held[0] == version:
        new = spark.table(states).where(F.col(tables.BATCH_ID).isin(batches)) if batches else newest.limit(0)
        ids = new.select(TRACKING_KEY).distinct()
        changed = tables.settle(newest.join(ids, TRACKING_KEY, "left_semi"), f"{staging}_changed")
        kept = enrich.flights_without(before, changed).drop(HISTORY_VERSION)
        join = enrich.touched_flights if side == "history" else enrich.active_with_history
        again = join(flights, changed, enrich.skew_plan(flights, changed)).drop(TRACKING_KEY)
        rows = kept.unionByName(again)
    else:
        rows = SIDES[side](flights, newest, enrich.skew_plan(flights, newest))
    rows = rows.withColumn(HISTORY_VERSION, F.lit(version))
    if not grace_seconds:
        _leave_out(spark, table, batches[:-1], grace_seconds)
    tables.overwrite_table(rows, merged, fmt, grace_seconds=grace_seconds)
    if grace_seconds:
        _leave_out(spark, table, batches[:-1], grace_seconds)
    if len(batches) > 1:
        _merge_batches(spark, states, newest, fmt, grace_seconds)
    return len(batches)


def _leave_out(spark: SparkSession, table: str, batches: list[int], grace_seconds: float) -> None:
    """Drops batches of the joined table, whose rows go after the grace period."""
    if spark.catalog.tableExists(table):
        tables.drop_batches(spark, table, batches)
        tables.sweep(spark, table, grace_seconds)


def _merge_batches(
    spark: SparkSession, table: str, rows: DataFrame, fmt: str, grace_seconds: float = tables.GRACE_SECONDS
) -> int:
    """Makes ``rows`` the one batch of a table besides its newest, which may be replayed;
    returns its number (negative, so no batch can take it)."""
    merged = tables.batch_ids(spark, table)[:-1]
    target = min(merged[0], 0) - 1
    tables.write_batch(rows, table, target, fmt)
    tables.drop_batches(spark, table, merged)
    tables.sweep(spark, table, grace_seconds)
    return target


def read_merged(spark: SparkSession, merged: str) -> DataFrame:
    """The current rows as ``merge_gold`` stored them."""
    return tables.snapshot(spark, merged)[1].drop(HISTORY_VERSION)


#: Table with the dashboard's summary of the joined table.
SUMMARY_TABLE = "resumen_tablero"


def store_summary(
    spark: SparkSession, table: str, summary: str, fmt: str = "parquet", *, merged: bool = False
) -> None:
    """Stores what the dashboard needs of the joined table (of its merged form where
    ``merged``), one row per flight and date."""
    rows = read_merged(spark, table) if merged else read_gold(spark, table)
    tables.overwrite_table(bi.summarise(rows), summary, fmt)


def compact_current(
    spark: SparkSession, table: str, fmt: str = "parquet", horizon: Horizon | None = None
) -> int | None:
    """Merges the log's batches into one row per flight that has not left; returns the
    number of the merged partition (negative, so no batch can take it).

    The newest batch is left out: it may not be committed, and its replay may be
    under way. Old partitions go only after the merged one is complete, and their rows
    stay for the readers that have begun. A run that stops halfway leaves copies of
    rows, which ``read_current`` ignores.
    """
    merged = tables.batch_ids(spark, table)[:-1]
    if len(merged) < 2:
        return None
    log = spark.table(table).where(F.col(tables.BATCH_ID).isin(merged))
    target = _merge_batches(spark, table, _standing(log, table, horizon), fmt)
    clocks = clock_table(table)
    if horizon and spark.catalog.tableExists(clocks) and len(tables.batch_ids(spark, clocks)) > 2:
        old = spark.table(clocks).where(F.col(tables.BATCH_ID).isin(tables.batch_ids(spark, clocks)[:-1]))
        sums = old.agg(*(f(c).alias(c) for f, c in ((F.max, "hasta"), (F.sum, "eventos"), (F.sum, "tardios"))))
        _merge_batches(spark, clocks, sums, fmt)
    return target


def preview(stream: DataFrame, view: str, rows: int = 20) -> StreamingQuery:
    """The first ``rows`` rows of a stream in a temp view, for a look at it.

    Stops as soon as the view is full, so what is read beyond that is the batch
    under way; ``maxFilesPerTrigger`` of the source bounds a batch.
    """
    writer = stream.limit(rows).writeStream.format("memory").queryName(view).outputMode("append")
    query = writer.trigger(availableNow=True).start()
    while not query.awaitTermination(0.2):
        if stream.sparkSession.table(view).count() >= rows:
            query.stop()
    return query
