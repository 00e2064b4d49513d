"""Column expressions over tracking events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.config import Horizon

# Normalised names of the late state and of those that end a flight, marker
# of a corrupt id.
LATE_STATE = "RETRASADO"
FINISHED_STATES = ("ATERRIZADO", "CANCELADO")
CORRUPT_ID_MARK = "_ERR"


def usable_flight_id(flight_id: Column) -> Column:
    """Present, not blank, and without the corruption marker (taken literally)."""
    return (
        flight_id.isNotNull()
        & (F.trim(flight_id) != "")
        & ~F.contains(flight_id, F.lit(CORRUPT_ID_MARK))
    )


def normal_state(state: Column) -> Column:
    return F.upper(F.trim(state))


def corrected_delay(state: Column, delay: Column, min_delay: int) -> Column:
    """Delay as reported, except that a late flight has at least some delay."""
    missing = F.coalesce(delay <= 0, F.lit(True))
    return F.when((state == LATE_STATE) & missing, F.lit(min_delay)).otherwise(delay)


def is_high_delay(delay: Column, limit: int) -> Column:
    """True from ``limit`` minutes on; an unknown delay is not high."""
    return F.coalesce(delay >= F.lit(limit), F.lit(False))


def is_over(state: Column, time: Column, clock: int, horizon: Horizon) -> Column:
    """Whether a flight with this newest event has left by the clock (microseconds)."""
    age = F.lit(clock) - F.unix_micros(time)
    over = normal_state(state).isin(*FINISHED_STATES) & (age > _micros(horizon.finished))
    return over if horizon.silent is None else over | (age > _micros(horizon.silent))


def is_late(time: Column, clock: int | None, horizon: Horizon) -> Column:
    """Whether an event comes too late to be taken, by the clock before its batch."""
    if clock is None:
        return F.lit(False)
    return F.lit(clock) - F.unix_micros(time) > _micros(horizon.finished)


def _micros(span: dt.timedelta) -> int:
    return span // dt.timedelta(microseconds=1)
