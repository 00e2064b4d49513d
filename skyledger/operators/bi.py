"""Dashboard queries: filters, counters and monthly summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE, YEAR, MONTH = "fecha_programada", "analisis_anio", "analisis_mes"


@dataclass(frozen=True)
class BiFilter:
    """State of the three dashboard filters; an empty one does not filter."""

    date_from: dt.date | None = None
    date_to: dt.date | None = None
    years: Collection[int] = ()
    months: Collection[int] = ()

    def by_column(self) -> dict[str, Column]:
        """Condition of each filter that is set, by the column it is on."""
        day = F.col(DATE)
        conditions: dict[str, Column] = {}
        if self.date_from is not None and self.date_to is not None:
            conditions[DATE] = day.between(F.lit(self.date_from), F.lit(self.date_to))
        elif self.date_from is not None:
            conditions[DATE] = day >= F.lit(self.date_from)
        elif self.date_to is not None:
            conditions[DATE] = day <= F.lit(self.date_to)
        if DATE in conditions:
            # What the dates say of year and month, so that partitions are skipped.
            first, last, year, month = self.date_from, self.date_to, F.col(YEAR), F.col(MONTH)
            if first is not None:
                conditions[DATE] &= year >= first.year
            if last is not None:
                conditions[DATE] &= year <= last.year
            if first is not None and last is not None and first.year == last.year:
                conditions[DATE] &= month.between(first.month, last.month)
        if self.years:
            conditions[YEAR] = F.col(YEAR).isin(*self.years)
        if self.months:
            conditions[MONTH] = F.col(MONTH).isin(*self.months)
        return conditions

    def apply(self, df: DataFrame) -> DataFrame:
        for condition in self.by_column().values():
            df = df.where(condition)
        return df


NO_FILTER = BiFilter()


# Column of a summary: how many rows of the full table a row stands for.
ROWS = "registros"


def summarise(df: DataFrame) -> DataFrame:
    """One row per flight id and date, enough for every query below.

    All of them take the full table, or this summary with ``summary=True``, and
    give the same answer. Stored after each load, it spares the dashboard six scans of the full table
    per refresh, and it does not grow with rows appended for known flights.
    """
    return df.groupBy(DATE, YEAR, MONTH, "id_vuelo").agg(
        F.count("*").alias(ROWS),
        F.sum("op_pasajeros_reservados").alias("op_pasajeros_reservados"),
    )


# Columns of a summary with bitmaps: which 32,768 flight numbers a row is about, and which
# of them occur. Numbers are dealt in runs, one for each task that numbers flights.
BUCKET, BITMAP, NUMBER = "tramo", "vuelos", "numero"
_RUN = 1 << 33


def number_flights(df: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A number for each flight id that ``known`` (``id_vuelo, numero``) has not. Store the
    result beside ``known``: numbers must stay as they are once a summary uses them.
    """
    ids = df.select("id_vuelo").where(F.col("id_vuelo").isNotNull()).distinct()
    first = 0
    if known is not None:
        ids = ids.join(known, "id_vuelo", "left_anti")
        last = known.agg(F.max(NUMBER)).first()[0]
        first = 0 if last is None else (last // _RUN + 1) * _RUN
    return ids.withColumn(NUMBER, F.monotonically_increasing_id() + first)


def summarise_bitmaps(df: DataFrame, numbers: DataFrame) -> DataFrame:
    """One row per date and run of 32,768 flight numbers, enough for every query below.

    Where flights fly daily, that is a handful of rows per date however many flights and
    rows there are, with the flights of the date as bits, so different flights are
    counted exactly without their ids. Summaries of several loads can be put together as
    they are. Flights without an id are counted as rows.
    """
    number = F.col(NUMBER)
    return (
        df.select(DATE, YEAR, MONTH, "id_vuelo", "op_pasajeros_reservados")
        .join(numbers, "id_vuelo", "left")
        .groupBy(DATE, YEAR, MONTH, F.bitmap_bucket_number(number).alias(BUCKET))
        .agg(
            F.count("*").alias(ROWS),
            F.sum("op_pasajeros_reservados").alias("op_pasajeros_reservados"),
            F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITMAP),
        )
    )


def flights_by_month_bitmaps(summary: DataFrame, filters: BiFilter = NO_FILTER) -> DataFrame:
    """``flights_by_month`` from a summary with bitmaps: tasks send one bitmap per month
    and run of numbers, no ids."""
    runs = filters.apply(summary).groupBy(MONTH, BUCKET).agg(
        F.sum(ROWS).alias(ROWS), F.bitmap_or_agg(BITMAP).alias(BITMAP)
    )
    different = F.when(F.col(BUCKET).isNotNull(), F.bitmap_count(F.col(BITMAP)))
    return runs.groupBy(MONTH).agg(
        F.sum(ROWS).alias("registros"),
        F.coalesce(F.sum(different), F.lit(0)).alias("vuelos_distintos"),
    )


def _count(summary: bool, condition: Column | None = None) -> Column:
    """Rows of the full table, of those that meet ``condition`` if given."""
    if summary:
        weight = F.col(ROWS) if condition is None else F.when(condition, F.col(ROWS))
        return F.coalesce(F.sum(weight), F.lit(0))
    return F.count("*") if condition is None else F.count_if(condition)


def total_flights(
    df: DataFrame, filters: BiFilter = NO_FILTER, *, summary: bool = False
) -> DataFrame:
    return filters.apply(df).agg(_count(summary).alias("total_vuelos"))


def passengers_by_month(df: DataFrame, filters: BiFilter = NO_FILTER) -> DataFrame:
    return filters.apply(df).groupBy(MONTH).agg(
        F.sum("op_pasajeros_reservados").alias("pasajeros")
    )


def flights_by_month(
    df: DataFrame, filters: BiFilter = NO_FILTER, *, summary: bool = False
) -> DataFrame:
    """Rows and distinct flight ids per month."""
    return filters.apply(df).groupBy(MONTH).agg(
        _count(summary).alias("registros"),
        F.count_distinct("id_vuelo").alias("vuelos_distintos"),
    )


def filter_options(
    df: DataFrame, column: str, filters: BiFilter = NO_FILTER, *, summary: bool = False
) -> DataFrame:
    """Each value of a filter's column, with the rows that pass the other
    filters. A value that has none stays in the list, with 0."""
    passes = F.lit(True)
    for name, condition in filters.by_column().items():
        if name != column:
            passes = passes & condition
    return df.groupBy(column).agg(_count(summary, passes).alias("asociados"))


def dashboard(
    df: DataFrame, filters: BiFilter = NO_FILTER, *, summary: bool = False
) -> dict[str, DataFrame]:
    """Every query of the dashboard, by the name of its widget."""
    return {
        "total_vuelos": total_flights(df, filters, summary=summary),
        "pasajeros_por_mes": passengers_by_month(df, filters),
        "vuelos_por_mes": flights_by_month(df, filters, summary=summary),
        "opciones_fecha": filter_options(df, DATE, filters, summary=summary),
        "opciones_anio": filter_options(df, YEAR, filters, summary=summary),
        "opciones_mes": filter_options(df, MONTH, filters, summary=summary),
    }
