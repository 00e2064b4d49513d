"""The registered queries: each operator over the supplied tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.config import Horizon, LakeConfig, Rules
from skyledger.functions import tracking as tr
from skyledger.operators import bi, buckets, enrich, gold, silver
from skyledger.operators import tracking as tk
from skyledger.operators.bronze import rename_flights, require_present, stamp_ingestion
from skyledger.operators.skew import heavy_keys
from skyledger.plans import batch
from skyledger.schemas import SOURCE_FLIGHT
from skyledger.session import shared_scratch, stream_session
from skyledger.sources import csv_files, generators, streams, tables
from skyledger.sources.star_tables import (
    bronze_flights,
    csv_text,
    event_bodies,
    source_flights,
    table,
)
from skyledger.streaming import jobs, metrics, pace

#: Parts in which the queries below store a history by flight.
FLIGHT_BUCKETS = 32

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RULES = Rules()
SALES_WINDOW = bi.BiFilter(
    date_from=dt.date(1996, 3, 1), date_to=dt.date(2000, 10, 31), years=(1996, 1998, 2000)
)
MONTHS_PICKED = bi.BiFilter(date_from=dt.date(1997, 1, 1), years=(1997, 1999), months=(2, 3, 11))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Types that look alike in any client, NULLs included: numbers as double,
    dates and flags as text, timestamps as microseconds since 1970."""

    def column(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.NumericType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.BooleanType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c).cast("double")
        return c.alias(f.name)

    return df.select(*(column(f) for f in df.schema))


def _flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_flights(bronze_flights(spark, sf_dir), RULES)


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_bodies(table(spark, sf_dir, "events"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tk.parse_events(_raw_events(spark, sf_dir))


def _lake(spark: SparkSession, label: str) -> LakeConfig:
    """Fresh environment in the shared scratch folder."""
    root = shared_scratch(spark, label)
    tag = root.rsplit("-", 1)[1]
    cfg = LakeConfig(catalog=f"b{tag}", stream_catalog=f"s{tag}", root=root)
    tables.create_schemas(spark, cfg)
    return cfg


def _stored(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame:
    """A query's result table, once the environment's other schemas and the landed and
    staged files are gone; the result itself is left to the session's owner."""
    kept = name.rsplit(".", 1)[0]
    for schema in tables.create_schemas(spark, cfg):
        if schema != kept:
            tables.drop_schema(spark, schema, confirm=schema)
    spent = [f"{cfg.root}/{folder}" for folder in ("landing", "staging", "staging_matched")]
    tables.delete_paths(spark, spent, root=cfg.root)
    return tables.read_table(spark, name)


# Bronze and silver


@query
def rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(bronze_flights(spark, sf_dir))


@query
def require_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(require_present(source_flights(table(spark, sf_dir, "lineitem"))))


@query
def ingest_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamped rows written to and read from a table; the stamp itself differs
    by run, so only whether it is set is returned."""
    cfg = _lake(spark, "ingest")
    name = cfg.table_name("bronze")
    tables.overwrite_table(stamp_ingestion(bronze_flights(spark, sf_dir)), name)
    stored = _stored(spark, cfg, name)
    return plain(stored.withColumn("ingestion_date", F.col("ingestion_date").isNotNull()))


@query
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.add_calendar(bronze_flights(spark, sf_dir))
    return plain(
        df.select("id_vuelo", "fecha_programada", "analisis_anio", "analisis_mes", "analisis_dia_semana")
    )


@query
def ticket_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.add_ticket_total(bronze_flights(spark, sf_dir))
    return plain(
        df.select("id_vuelo", "tarifa_costo_base", "tarifa_impuestos", "tarifa_precio_total_ticket")
    )


@query
def low_cost_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = bronze_flights(spark, sf_dir).transform(silver.add_ticket_total).transform(silver.add_low_cost, RULES)
    return plain(df.select("id_vuelo", "tarifa_precio_total_ticket", "indicador_es_bajo_costo"))


@query
def route_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.add_route(bronze_flights(spark, sf_dir))
    return df.select("id_vuelo", "geo_origen", "geo_destino", "geo_id_ruta")


@query
def km_to_miles(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.add_miles(bronze_flights(spark, sf_dir), RULES)
    return df.select("id_vuelo", "op_distancia_km", "op_distancia_millas")


@query
def high_capacity_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.add_high_capacity(bronze_flights(spark, sf_dir), RULES)
    return plain(df.select("id_vuelo", "capacidad_pasajeros", "indicador_alta_capacidad"))


@query
def silver_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_flights(spark, sf_dir))


# Gold


@query
def gold_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(gold.monthly_by_route(_flights(spark, sf_dir)))


@query
def gold_airline_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(gold.monthly_by_airline(_flights(spark, sf_dir)))


@query
def gold_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type of each gold column and how many groups have a value in it."""
    df = gold.monthly_by_route(_flights(spark, sf_dir))
    return _typed_counts(df, {name: kind for name, kind, _ in batch.schema_report(df)})


def _typed_counts(df: DataFrame, types: dict[str, str]) -> DataFrame:
    counted = df.agg(*(F.count(name).alias(name) for name in types))
    kind = F.lit(None).cast("string")
    for name, text in types.items():
        kind = F.when(F.col("columna") == name, text).otherwise(kind)
    return counted.unpivot([], list(types), "columna", "valores").withColumn("tipo", kind)


# CSV source


def _staged_csv(spark: SparkSession, sf_dir: str) -> str:
    path = shared_scratch(spark, "csv")
    csv_files.write_flights(csv_text(source_flights(table(spark, sf_dir, "lineitem"))), path)
    return path


@query
def csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose column order differs from the declared one."""
    return plain(rename_flights(csv_files.read_flights(spark, _staged_csv(spark, sf_dir))))


@query
def csv_bad_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_files.bad_cell_report(spark, _staged_csv(spark, sf_dir))


@query
def csv_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guessed type of each column, next to the number of values it has."""
    path = _staged_csv(spark, sf_dir)
    guessed = csv_files.infer_schema(spark, path)
    types = {f.name: f.dataType.simpleString() for f in guessed}
    return _typed_counts(csv_files.read_text_columns(spark, path), types)


# Tracking events as a batch


@query
def parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_events(spark, sf_dir))


@query
def unreadable_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = tk.unreadable_events(_raw_events(spark, sf_dir))
    return bad.select("sequenceNumber", F.col("body").cast("string").alias("body"))


@query
def clean_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(tk.clean_events(_events(spark, sf_dir)))


@query
def normalize_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.col("Estado_Actual")
    return _events(spark, sf_dir).select(
        "ID_Vuelo", state, tr.normal_state(state).alias("estado_actual_normalizado")
    )


@query
def delay_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = tk.add_state_columns(_events(spark, sf_dir), RULES)
    return plain(
        df.select("ID_Vuelo", "estado_actual_normalizado", "Retraso_Minutos", "tracking_retraso_minutos")
    )


@query
def high_delay_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = tk.add_state_columns(_events(spark, sf_dir), RULES)
    return plain(df.select("ID_Vuelo", "tracking_retraso_minutos", "indicador_retraso_alto"))


@query
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By ``row_number``, the form the joins and batches use."""
    return plain(tk.latest_state(_events(spark, sf_dir), RULES, tk.latest_per_key))


@query
def latest_state_by_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By aggregate, the form a stream with state needs."""
    return plain(tk.latest_state(_events(spark, sf_dir), RULES, tk.latest_by_max))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest states, settled so that the join is planned with their size."""
    latest = tk.latest_state(_events(spark, sf_dir), RULES)
    return tables.settle(latest, shared_scratch(spark, "latest"))


@query
def latest_state_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = _flights(spark, sf_dir)
    latest = _latest(spark, sf_dir)
    return plain(enrich.flights_with_state(flights, latest, enrich.skew_plan(flights, latest)))


def _uneven_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flights with all of business class, some 40 % of the rows, on
    one flight id."""
    crowded = F.when(F.col("tarifa_clase") == "Negocios", "AA7").otherwise(F.col("id_vuelo"))
    return _flights(spark, sf_dir).withColumn("id_vuelo", crowded)


@query
def latest_state_enriched_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history with a dominating flight id, spread by salt."""
    flights = _uneven_flights(spark, sf_dir)
    heavy = heavy_keys(flights, enrich.FLIGHT)
    return plain(enrich.flights_with_state(flights, _latest(spark, sf_dir), heavy))


@query
def active_enriched_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = _uneven_flights(spark, sf_dir)
    heavy = heavy_keys(flights, enrich.FLIGHT)
    return plain(enrich.active_with_history(flights, _latest(spark, sf_dir), heavy))


@query
def active_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = _flights(spark, sf_dir)
    latest = _latest(spark, sf_dir)
    heavy = enrich.skew_plan(flights, latest)
    matched = shared_scratch(spark, "matched")
    return plain(enrich.active_with_history(flights, latest, heavy, matched))


@query
def active_enriched_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history stored in parts by flight; those without a tracked flight are not read.
    Tracked are the flights whose id ends in 7."""
    cfg = _lake(spark, "parts")
    history = cfg.table_name("silver")
    flights = buckets.add(_flights(spark, sf_dir), FLIGHT_BUCKETS)
    tables.overwrite_table(flights, history, partition_by=[buckets.column(FLIGHT_BUCKETS)])
    latest = _latest(spark, sf_dir).where(F.col("tracking_key").endswith("7"))
    stored = _stored(spark, cfg, history)
    heavy = enrich.skew_plan(stored, latest)
    return plain(enrich.active_with_history(stored, latest, heavy, shared_scratch(spark, "matched")))


# Dashboard


@query
def bi_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT *`` over the flights with state, as the dashboard's dataset."""
    flights, latest = _flights(spark, sf_dir), _latest(spark, sf_dir)
    joined = enrich.flights_with_state(flights, latest, enrich.skew_plan(flights, latest))
    joined.createOrReplaceTempView("vuelos")
    return plain(tables.read_table(spark, "vuelos"))


@query
def bi_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.total_flights(_flights(spark, sf_dir))


@query
def bi_total_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.total_flights(_flights(spark, sf_dir), MONTHS_PICKED)


@query
def bi_passengers_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.passengers_by_month(_flights(spark, sf_dir))


@query
def bi_flights_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.flights_by_month(_flights(spark, sf_dir), SALES_WINDOW)


@query
def bi_filter_options_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.filter_options(_flights(spark, sf_dir), bi.MONTH, MONTHS_PICKED)


@query
def bi_filter_options_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.filter_options(_flights(spark, sf_dir), bi.YEAR, MONTHS_PICKED)


@query
def bi_filter_options_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(bi.filter_options(_flights(spark, sf_dir), bi.DATE, MONTHS_PICKED))


@query
def bi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(bi.summarise(_flights(spark, sf_dir)))


@query
def bi_flights_month_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bi_flights_month`` from a stored summary."""
    summary = tables.settle(bi.summarise(_flights(spark, sf_dir)), shared_scratch(spark, "summary"))
    return bi.flights_by_month(summary, SALES_WINDOW, summary=True)


def _bitmap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, the second with flights that the first does not know; each is numbered
    and summarised alone."""
    root = shared_scratch(spark, "bitmaps")
    flights, parts, known = _flights(spark, sf_dir), [], None
    early = F.coalesce(F.col("fecha_programada") < dt.date(1998, 6, 1), F.lit(False))
    for i, load in enumerate((flights.where(early), flights.where(~early))):
        new = tables.settle(bi.number_flights(load, known), f"{root}/numbers{i}")
        known = new if known is None else known.unionByName(new)
        parts.append(tables.settle(bi.summarise_bitmaps(load, known), f"{root}/summary{i}"))
    return parts[0].unionByName(parts[1])


@query
def bi_flights_month_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bi_flights_month`` from stored bitmaps."""
    return bi.flights_by_month_bitmaps(_bitmap_summary(spark, sf_dir), SALES_WINDOW)


@query
def bi_options_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bi_filter_options_month`` from the same summary."""
    return bi.filter_options(_bitmap_summary(spark, sf_dir), bi.MONTH, MONTHS_PICKED, summary=True)


# Streams: the whole events table arrives as files, in about four batches


def _landed_events(spark: SparkSession, sf_dir: str, cfg: LakeConfig) -> tuple[str, int]:
    """Messages as files, one folder per hub partition; returns the folder and
    the number of files that makes about four batches."""
    path = f"{cfg.root}/landing"
    _raw_events(spark, sf_dir).write.partitionBy("partition").parquet(path)
    files = len(spark.read.schema("body binary").parquet(path).inputFiles())
    return path, max(1, files // 4)


def _bronze_stream(spark: SparkSession, sf_dir: str, cfg: LakeConfig) -> str:
    path, step = _landed_events(spark, sf_dir, cfg)
    name = cfg.table_name("bronze", stream=True)
    source = streams.read_events(spark, path=path, maxFilesPerTrigger=str(step))
    jobs.start_bronze(source, name, cfg.checkpoint("bronze")).awaitTermination()
    return name


@query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _lake(spark, "stream_bronze")
    stored = _stored(spark, cfg, _bronze_stream(stream_session(spark), sf_dir, cfg))
    return plain(stored.withColumn("body", F.col("body").cast("string")))


@query
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _lake(spark, "stream_silver")
    session = stream_session(spark)
    bronze = _bronze_stream(session, sf_dir, cfg)
    name = cfg.table_name("silver", stream=True)
    jobs.start_silver(
        streams.follow_table(session, bronze), name, cfg.checkpoint("silver")
    ).awaitTermination()
    return plain(_stored(spark, cfg, name))


@query
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches of the parsed events say of themselves, added up."""
    cfg = _lake(spark, "stream_counts")
    session = stream_session(spark)
    bronze = _bronze_stream(session, sf_dir, cfg)
    counts = cfg.table_name("silver", stream=True, table=jobs.COUNTS_TABLE)
    events, listener = metrics.start_counted_silver(
        streams.follow_table(session, bronze),
        cfg.table_name("silver", stream=True),
        counts,
        cfg.checkpoint("silver"),
        jobs.start_append,
    )
    try:
        listener.wait(events)
    finally:
        session.streams.removeListener(listener)
    stored = _stored(spark, cfg, counts)
    names = [c for c in stored.columns if c not in ("hora", tables.BATCH_ID)]
    return plain(stored.agg(*(F.sum(c).alias(c) for c in names)))


@query
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _lake(spark, "stream_rejects")
    session = stream_session(spark)
    bronze = _bronze_stream(session, sf_dir, cfg)
    name = cfg.table_name("silver", stream=True, table=jobs.REJECTS_TABLE)
    jobs.start_rejects(
        streams.follow_table(session, bronze), name, cfg.checkpoint("rejects")
    ).awaitTermination()
    return _stored(spark, cfg, name).select("sequenceNumber", F.col("body").cast("string").alias("body"))


def _gold_stream(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    cfg = _lake(spark, f"stream_gold_{side}")
    session = stream_session(spark)
    bronze = _bronze_stream(session, sf_dir, cfg)
    history = cfg.table_name("silver")
    tables.overwrite_table(_flights(spark, sf_dir), history)
    name = cfg.table_name("gold", stream=True)
    jobs.start_gold(
        streams.follow_table(session, bronze),
        history,
        name,
        cfg.checkpoint("gold"),
        rules=RULES,
        side=side,
    ).awaitTermination()
    return plain(_stored(spark, cfg, name).drop(tables.BATCH_ID, jobs.HISTORY_VERSION))


@query
def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in one batch, so the result equals the batch join."""
    return _gold_stream(spark, sf_dir, "history")


@query
def stream_gold_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_stream(spark, sf_dir, "active")


@query
def gold_batches_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hub partition as a batch of its own, the third one written twice, and a
    batch without events."""
    cfg = _lake(spark, "gold_batches")
    history, name = cfg.table_name("silver"), cfg.table_name("gold", stream=True)
    tables.overwrite_table(_flights(spark, sf_dir), history)
    write = jobs.gold_batch_writer(history, name, f"{cfg.root}/staging", rules=RULES, side="active")
    raw = _raw_events(spark, sf_dir)
    for batch_id in (0, 1, 2, 3, 2, 4):
        write(tk.parse_events(raw.where(F.col("partition") == str(batch_id))), batch_id)
    return plain(_stored(spark, cfg, name).drop(jobs.HISTORY_VERSION))


@query
def gold_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each batch, of which the second has no events: it writes nothing, also
    where a batch has a row for every flight of the history."""
    cfg = _lake(spark, "gold_empty")
    history, name = cfg.table_name("silver"), cfg.table_name("gold", stream=True)
    tables.overwrite_table(_flights(spark, sf_dir), history)
    write = jobs.gold_batch_writer(history, name, f"{cfg.root}/staging", rules=RULES, side="history")
    raw = _raw_events(spark, sf_dir)
    for batch_id, hub in enumerate(("0", "none", "1")):
        write(tk.parse_events(raw.where(F.col("partition") == hub)), batch_id)
    stored = _stored(spark, cfg, name).groupBy(tables.BATCH_ID).agg(F.count("*").alias("vuelos"))
    return plain(stored)


def _merged_gold(spark: SparkSession, sf_dir: str, label: str, side: str, loads: dict[int, DataFrame]) -> DataFrame:
    """Current rows after four batches, merged after the second and at the end; ``loads``:
    what is loaded as the history before a batch. Nobody else reads this environment, so
    nothing is kept for readers of loads and batches that are not live any more."""
    cfg = _lake(spark, label)
    history, name = cfg.table_name("silver"), cfg.table_name("gold", stream=True)
    merged = cfg.table_name("gold", stream=True, table=jobs.MERGED_TABLE)
    staging = f"{cfg.root}/staging"
    write = jobs.gold_batch_writer(history, name, staging, rules=RULES, side=side)
    raw = _raw_events(spark, sf_dir)
    for batch_id in range(4):
        if batch_id in loads:
            flights, parts = buckets.add(loads[batch_id], FLIGHT_BUCKETS), [buckets.column(FLIGHT_BUCKETS)]
            tables.overwrite_table(flights, history, partition_by=parts, grace_seconds=0, gather=False)
        write(tk.parse_events(raw.where(F.col("partition") == str(batch_id))), batch_id)
        if batch_id % 2:
            jobs.merge_gold(spark, history, name, merged, staging, side=side, grace_seconds=0)
    tables.delete_paths(spark, [f"{staging}_states", f"{staging}_changed"], root=cfg.root)
    _stored(spark, cfg, name)
    return jobs.read_merged(spark, merged)


@query
def gold_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches over one load of the history; the second merge joins again only the
    flights with newer events."""
    return plain(_merged_gold(spark, sf_dir, "gold_merged", "history", {0: _flights(spark, sf_dir)}))


def _old_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier load: fewer flights, with other seats and airlines."""
    return _flights(spark, sf_dir).where("analisis_mes <= 9").withColumns(
        {"capacidad_pasajeros": F.col("capacidad_pasajeros") + 1, "info_aerolinea": F.lit("antes")}
    )


@query
def gold_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history is loaded again between the batches; all current rows are of the
    second load, whichever batch brought their state."""
    loads = {0: _old_load(spark, sf_dir), 2: _flights(spark, sf_dir)}
    return plain(_merged_gold(spark, sf_dir, "gold_reloaded", "history", loads))


@query
def gold_reloaded_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = {0: _old_load(spark, sf_dir), 3: _flights(spark, sf_dir)}
    return plain(_merged_gold(spark, sf_dir, "gold_reloaded_active", "active", loads))


@query
def bi_total_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = {0: _old_load(spark, sf_dir), 1: _flights(spark, sf_dir)}
    return bi.total_flights(_merged_gold(spark, sf_dir, "bi_total_merged", "history", loads))


def _gold_by_hub(spark: SparkSession, sf_dir: str) -> str:
    """The joined table after four batches, each of which wrote every flight."""
    cfg = _lake(spark, "gold_by_hub")
    history, name = cfg.table_name("silver"), cfg.table_name("gold", stream=True)
    tables.overwrite_table(_flights(spark, sf_dir), history)
    write = jobs.gold_batch_writer(history, name, f"{cfg.root}/staging", rules=RULES, side="history")
    raw = _raw_events(spark, sf_dir)
    for batch_id in range(4):
        write(tk.parse_events(raw.where(F.col("partition") == str(batch_id))), batch_id)
    _stored(spark, cfg, name)
    return name


@query
def gold_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows of the stored joined table, each flight once."""
    return plain(jobs.read_gold(spark, _gold_by_hub(spark, sf_dir)))


@query
def bi_total_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.total_flights(jobs.read_gold(spark, _gold_by_hub(spark, sf_dir)))


@query
def bi_passengers_month_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.passengers_by_month(jobs.read_gold(spark, _gold_by_hub(spark, sf_dir)))


@query
def bi_filter_options_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the summary that is stored of the joined table."""
    gold_table = _gold_by_hub(spark, sf_dir)
    summary = f"{gold_table.rsplit('.', 1)[0]}.{jobs.SUMMARY_TABLE}"
    jobs.store_summary(spark, gold_table, summary)
    stored = tables.read_table(spark, summary)
    return bi.filter_options(stored, bi.MONTH, MONTHS_PICKED, summary=True)


@query
def gold_batches_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of one table, the second with a column more."""
    cfg = _lake(spark, "gold_columns")
    name, flights = cfg.table_name("gold", stream=True), _flights(spark, sf_dir)
    tables.write_batch(flights.where("analisis_mes <= 6").select("id_vuelo"), name, 0)
    tables.write_batch(flights.where("analisis_mes > 6").select("id_vuelo", "info_aerolinea"), name, 1)
    stored = _stored(spark, cfg, name).groupBy("batch_id")
    return plain(stored.agg(F.count("*").alias("vuelos"), F.count("info_aerolinea").alias("con_aerolinea")))


@query
def stream_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a preview of 20 shows, and how many of them are events."""
    cfg = _lake(spark, "preview")
    path, step = _landed_events(spark, sf_dir, cfg)
    source = streams.read_events(spark, path=path, maxFilesPerTrigger=str(step))
    view = f"preview_{cfg.catalog}"
    jobs.preview(source, view, rows=20).awaitTermination()
    sent = _raw_events(spark, sf_dir).select("sequenceNumber").withColumn("sent", F.lit(1))
    shown = spark.table(view).join(sent, "sequenceNumber", "left")
    return shown.agg(F.count("*").alias("filas"), F.count("sent").alias("filas_conocidas"))


def _current_stream(spark: SparkSession, sf_dir: str, stateful: bool) -> tuple[str, LakeConfig]:
    cfg = _lake(spark, "stream_current")
    path, step = _landed_events(spark, sf_dir, cfg)
    source = streams.read_events(stream_session(spark), path=path, maxFilesPerTrigger=str(step))
    name = cfg.table_name("gold", stream=True, table=jobs.CURRENT_TABLE)
    jobs.start_current(source, name, cfg.checkpoint("current"), stateful=stateful).awaitTermination()
    _stored(spark, cfg, name)
    return name, cfg


@query
def stream_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, _ = _current_stream(spark, sf_dir, stateful=True)
    return plain(jobs.read_current(spark, name, RULES))


@query
def stream_current_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, _ = _current_stream(spark, sf_dir, stateful=False)
    return plain(jobs.read_current(spark, name, RULES))


@query
def stream_current_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, _ = _current_stream(spark, sf_dir, stateful=False)
    jobs.compact_current(spark, name)
    return plain(jobs.read_current(spark, name, RULES))


#: Finished flights stay six hours, silent ones a day.
HORIZON = Horizon(dt.timedelta(hours=6), dt.timedelta(days=1))


def _expiring_log(spark: SparkSession, sf_dir: str) -> str:
    """A log of batches of ten days of events each, of which every ninth comes with the
    next batch; compacted twice on the way."""
    cfg = _lake(spark, "expiring")
    name = cfg.table_name("gold", stream=True, table=jobs.CURRENT_TABLE)
    write = jobs.current_batch_writer(name, horizon=HORIZON)
    events = tables.settle(tk.clean_events(_events(spark, sf_dir)), f"{cfg.root}/landing")
    time = F.col(tk.TIME)
    delayed = (F.unix_micros(time) % 9 == 0).cast("int")
    batch_of = F.floor((F.dayofmonth(time) - 1) / 10) + delayed
    for batch_id in range(5):
        write(events.where(batch_of == batch_id), batch_id)
        if batch_id in (2, 3):
            jobs.compact_current(spark, name, horizon=HORIZON)
    _stored(spark, cfg, name)
    return name


@query
def stream_current_expiring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current states when flights leave and late events are not taken."""
    return plain(jobs.read_current(spark, _expiring_log(spark, sf_dir), RULES, HORIZON))


@query
def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches say of themselves: events, late ones, newest time."""
    told = spark.table(jobs.clock_table(_expiring_log(spark, sf_dir)))
    return plain(
        told.agg(F.sum("eventos").alias("eventos"), F.sum("tardios").alias("tardios"), F.max("hasta").alias("hasta"))
    )


@query
def operational_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state of each tracked flight with its history, joined on reading
    so that no batch has to write the history again."""
    name, cfg = _current_stream(spark, sf_dir, stateful=False)
    current = tables.settle(jobs.read_current(spark, name, RULES), f"{cfg.root}/current")
    flights = _flights(spark, sf_dir)
    heavy = enrich.skew_plan(flights, current)
    return plain(enrich.active_with_history(flights, current, heavy, f"{cfg.root}/matched"))


@query
def paced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many events of generated flights as there are customers, in three batches."""
    cfg = _lake(spark, "paced")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    flights = generators.flights_for(orders, "o_orderkey")
    each = -(-table(spark, sf_dir, "customer").count() // 3)
    path = f"{cfg.root}/paced"
    how = {"heavy_per_mille": 300, "damaged_per_mille": 40}
    pace.emit(stream_session(spark), flights, path, each, 3, cfg.checkpoint("paced"), **how)
    return plain(tk.parse_events(spark.read.parquet(path)))


# Tables, the batch chain, generated inputs


@query
def batch_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to bronze to silver to gold, handed over as tables."""
    cfg = _lake(spark, "chain")
    csv = _staged_csv(spark, sf_dir)
    batch.run(spark, cfg, csv)
    tables.delete_paths(spark, [csv], root=csv.rsplit("/", 1)[0])
    return plain(_stored(spark, cfg, cfg.table_name("gold")))


@query
def airline_month_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up by airline as the batch chain stores it."""
    cfg = _lake(spark, "airlines")
    tables.overwrite_table(_flights(spark, sf_dir), cfg.table_name("silver"))
    batch.load(spark, cfg)
    return plain(_stored(spark, cfg, cfg.table_name("gold", table=batch.AIRLINE_TABLE)))


def _incremental(spark: SparkSession, sf_dir: str, result: str) -> DataFrame:
    """Monthly results after three loads, the second of which comes twice: first with
    flights that belong to the third, then as it should be."""
    cfg = _lake(spark, "incremental")
    flights = _flights(spark, sf_dir)
    first_class = F.coalesce(F.col("tarifa_clase") == "Primera", F.lit(False))
    early = F.coalesce(F.col("analisis_mes") <= 3, F.lit(True))
    batch.load_increment(spark, cfg, flights.where(~first_class), 0)
    batch.load_increment(spark, cfg, flights.where(first_class & ~early), 1)
    batch.load_increment(spark, cfg, flights.where(first_class & early), 1)
    batch.load_increment(spark, cfg, flights.where(first_class & ~early), 2)
    return _stored(spark, cfg, cfg.table_name("gold", table=result)).drop(gold.PERIOD)


@query
def gold_monthly_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_incremental(spark, sf_dir, batch.MONTHS_TABLE))


@query
def gold_airline_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_incremental(spark, sf_dir, batch.AIRLINE_MONTHS_TABLE))


@query
def batch_chain_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain whose last step is missing is run again: bronze and silver are the loads
    they were, gold is made."""
    cfg = _lake(spark, "resumed")
    csv = _staged_csv(spark, sf_dir)
    batch.run(spark, cfg, csv)
    names = [cfg.table_name(layer) for layer in ("bronze", "silver")]
    loads = [tables.version(spark, name) for name in names]
    tables.drop_tables(spark, [cfg.table_name("gold")])
    batch.run(spark, cfg, csv, resume=True)
    same = loads == [tables.version(spark, name) for name in names]
    tables.delete_paths(spark, [csv], root=csv.rsplit("/", 1)[0])
    stored = _stored(spark, cfg, cfg.table_name("gold"))
    return plain(stored.withColumn("cargas_iguales", F.lit(same)))


@query
def silver_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver stored by year and month, read back through the dashboard filter
    (which then skips the other partitions)."""
    cfg = _lake(spark, "partitioned")
    name = cfg.table_name("silver")
    tables.overwrite_table(_flights(spark, sf_dir), name, partition_by=("analisis_anio", "analisis_mes"))
    return bi.passengers_by_month(_stored(spark, cfg, name), MONTHS_PICKED)


@query
def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, overwrite and drop: what is left is the second version of one
    table, and none of the dropped ones."""
    cfg = _lake(spark, "lifecycle")
    flights = bronze_flights(spark, sf_dir)
    kept, gone = cfg.table_name("bronze"), cfg.table_name("exploratory", table="borrador")
    tables.overwrite_table(flights.select("id_vuelo"), kept)
    tables.overwrite_table(flights, kept)
    tables.overwrite_table(flights.select("id_vuelo"), gone)
    # Folders that belong to no schema, as checkpoints do, which only the delete removes.
    strays = [cfg.checkpoint("borrador"), f"{cfg.root}/landing/borrador"]
    for stray in strays:
        flights.select("id_vuelo").limit(1).write.parquet(stray)
    batch.teardown(spark, cfg, tables_to_drop=[gone], paths=strays)
    tables.drop_schema(spark, cfg.schema("exploratory"), confirm=cfg.schema("exploratory"))
    schema_left = spark.catalog.databaseExists(cfg.schema("exploratory"))
    paths_left = [stray for stray in strays if tables.path_exists(spark, stray)]
    place = spark.sql(f"DESCRIBE EXTENDED {kept}").where("col_name = 'Location'").first()[1]
    return (
        tables.read_table(spark, kept)
        .groupBy("info_aerolinea")
        .agg(F.count("*").alias("vuelos"), F.sum("capacidad_pasajeros").alias("capacidad"))
        .withColumn("borrador_existe", F.lit(spark.catalog.tableExists(gone)))
        .withColumn("esquema_existe", F.lit(schema_left))
        .withColumn("carpetas_quedan", F.lit(len(paths_left)))
        .withColumn("en_su_carpeta", F.lit(cfg.location("bronze") in place))
    )


@query
def generate_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated flight for each order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    drawn = generators.flights_for(orders, "o_orderkey")
    return plain(drawn.select(*SOURCE_FLIGHT.fieldNames()))


@query
def generate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of those flights, parsed again from their JSON."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    flights = generators.flights_for(orders, "o_orderkey")
    return plain(tk.parse_events(generators.events_for(flights, damaged_per_mille=40)))


@query
def generate_events_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event of those flights for each row of ``events``, 30 % of them of one flight."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    flights = generators.flights_for(orders, "o_orderkey")
    slots = table(spark, sf_dir, "events").select("event_id")
    bodies = generators.one_event_each(
        slots, "event_id", flights, heavy_per_mille=300, damaged_per_mille=40
    )
    return plain(tk.parse_events(bodies))
