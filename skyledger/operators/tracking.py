"""Tracking events: parse, clean, keep the latest state of each flight."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.config import Rules
from skyledger.functions import tracking as tr
from skyledger.schemas import TRACKING_COLUMNS, TRACKING_EVENT, TRACKING_KEY

KEY = "ID_Vuelo"
TIME = "Timestamp_Evento"


def _read_bodies(body: str) -> Column:
    """Event fields of a binary JSON body.

    The one-element ``inline`` keeps the parse in an operator of its own. As a
    plain projection it would be copied into every later filter condition, and
    each copy would parse the body again.
    """
    return F.inline(F.array(F.from_json(F.col(body).cast("string"), TRACKING_EVENT)))


def parse_events(raw: DataFrame, body: str = "body") -> DataFrame:
    """Binary JSON body to the eight event fields.

    A body that cannot be read gives NULL fields, never an error.
    """
    return raw.select(_read_bodies(body))


def unreadable_events(raw: DataFrame, body: str = "body") -> DataFrame:
    """Input rows whose body yields no field at all, with every input column."""
    fields = TRACKING_EVENT.fieldNames()
    found = F.coalesce(*(F.col(name).cast("string") for name in fields))
    return raw.select("*", _read_bodies(body)).where(found.isNull()).drop(*fields)


def clean_events(events: DataFrame) -> DataFrame:
    """Events with a usable flight id and a time."""
    return events.where(tr.usable_flight_id(F.col(KEY)) & F.col(TIME).isNotNull())


def newest_first(columns: list[str], time: str = TIME, key: str = KEY) -> list[str]:
    """Columns that decide which event is newer: the time, then every other
    field. Events equal in all of them are equal rows, so any may win."""
    return [time, *(c for c in columns if c not in (time, key))]


def latest_per_key(
    events: DataFrame, key: str = KEY, time: str = TIME, tie_break: list[str] | None = None
) -> DataFrame:
    """The newest row of each key, by ``row_number() = 1``.

    Spark keeps one row per key in each map task before the shuffle
    (WindowGroupLimit), so a key with a third of all events sends one row per
    task.
    """
    order = [time, *tie_break] if tie_break else newest_first(events.columns, time, key)
    newest = Window.partitionBy(key).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return (
        events.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_by_max(events: DataFrame, key: str = KEY, time: str = TIME) -> DataFrame:
    """The newest row of each key, as an aggregate.

    ``max`` over a struct compares its fields in turn, NULL lowest: the order
    ``latest_per_key`` sorts by, hence the same rows. It merges, so it also works
    on a stream; on a batch ``latest_per_key`` is faster.
    """
    newest = F.max(F.struct(*newest_first(events.columns, time, key))).alias("newest")
    return events.groupBy(key).agg(newest).select(key, "newest.*").select(*events.columns)


def add_state_columns(events: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Normalised state, corrected delay and high-delay flag."""
    state = tr.normal_state(F.col("Estado_Actual"))
    delay = tr.corrected_delay(
        F.col("estado_actual_normalizado"), F.col("Retraso_Minutos"), rules.min_delay
    )
    high = tr.is_high_delay(F.col("tracking_retraso_minutos"), rules.high_delay)
    return (
        events.withColumn("estado_actual_normalizado", state)
        .withColumn("tracking_retraso_minutos", delay)
        .withColumn("indicador_retraso_alto", high)
    )


def tracking_view(events: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Join key plus the columns the joined tables carry."""
    return add_state_columns(events, rules).select(
        F.col(KEY).alias(TRACKING_KEY),
        F.col(TIME).alias("tracking_timestamp_evento"),
        "estado_actual_normalizado",
        "tracking_retraso_minutos",
        "indicador_retraso_alto",
        F.col("Puerta_Asignada").alias("tracking_puerta_asignada"),
        F.col("Ruta_Evento").alias("tracking_ruta_evento"),
        F.col("Nivel_Servicio").alias("tracking_nivel_servicio"),
        F.col("Consumo_Combustible_Litros").alias("tracking_consumo_combustible_litros"),
    ).select(TRACKING_KEY, *TRACKING_COLUMNS)


def latest_state(
    events: DataFrame,
    rules: Rules = Rules(),
    pick: Callable[[DataFrame], DataFrame] = latest_per_key,
) -> DataFrame:
    """Latest state per flight.

    The derived columns depend on one row only, so they are computed after the
    selection: on one row per flight and not on every event.
    """
    return events.transform(clean_events).transform(pick).transform(tracking_view, rules)
