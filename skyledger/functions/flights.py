"""Column expressions over scheduled flights."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_parts(day: Column) -> dict[str, Column]:
    """Year, month and day of week (1 = Sunday) of a date."""
    return {
        "analisis_anio": F.year(day),
        "analisis_mes": F.month(day),
        "analisis_dia_semana": F.dayofweek(day),
    }


def ticket_total(base_cost: Column, taxes: Column) -> Column:
    """Fare plus taxes, half-up to cents; NULL when either part is NULL."""
    return F.round(base_cost + taxes, 2)


def is_low_cost(total: Column, limit: Decimal) -> Column:
    """True below ``limit``; an unknown total is not low cost."""
    return F.coalesce(total < F.lit(limit), F.lit(False))


def route_key(origin: Column, destination: Column) -> Column:
    """``ORIGIN-DEST``; NULL when either end is unknown."""
    return F.concat(origin, F.lit("-"), destination)


def km_to_miles(km: Column, miles_per_km: float) -> Column:
    return F.round(km * F.lit(miles_per_km), 2)


def high_capacity_flag(seats: Column, limit: int) -> Column:
    """1 from ``limit`` seats on, else 0; unknown capacity counts as 0."""
    return F.coalesce((seats >= F.lit(limit)).cast("int"), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, 0 for an unknown or zero ``whole``."""
    share = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.round(F.coalesce(share, F.lit(0.0)) * 100, 2)


def per_unit(amount: Column, units: Column) -> Column:
    """``amount / units`` to cents, 0 for unknown or zero ``units``."""
    value = F.try_divide(amount.cast("double"), units.cast("double"))
    return F.round(F.coalesce(value, F.lit(0.0)), 2)
