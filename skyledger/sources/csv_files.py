"""Historical flights as CSV files with a header line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.schemas import CSV_ORDER, SOURCE_FLIGHT


def infer_schema(spark: SparkSession, path: str, sampling: float = 1.0) -> T.StructType:
    """Types Spark would guess for a CSV.

    For profiling an unknown file; it reads the data, so loads do not use it.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sampling)
        .csv(path)
        .schema
    )


def read_text_columns(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a CSV as text, under the names of its header.

    The names come from one file's header; ``enforceSchema=false`` makes Spark
    compare them with the header of every file it reads, so a file with another
    column order stops the load instead of filling the wrong columns.
    """
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def _typed(field: T.StructField) -> Column:
    value = F.col(field.name)
    return value if isinstance(field.dataType, T.StringType) else value.try_cast(field.dataType)


def _unreadable(field: T.StructField) -> Column:
    return F.count_if(F.col(field.name).isNotNull() & _typed(field).isNull())


def _checked_fields() -> list[T.StructField]:
    return [f for f in SOURCE_FLIGHT if not isinstance(f.dataType, T.StringType)]


def by_name(text: DataFrame) -> DataFrame:
    """Text columns to the declared columns: matched by name, a cell that does
    not fit its type becomes NULL."""
    return text.select(*(_typed(field).alias(field.name) for field in SOURCE_FLIGHT))


def read_flights(
    spark: SparkSession, *paths: str, bad_cells: Observation | None = None
) -> DataFrame:
    """Flights from one or more CSV locations.

    Each location may have its own column order. ``bad_cells`` receives the
    number of unreadable cells per column from the pass that writes the result,
    so counting them costs no second read; it needs a single location.
    """
    if not paths:
        raise ValueError("no CSV location given")
    if bad_cells is not None and len(paths) > 1:
        raise ValueError("bad_cells takes one location per call")
    flights = None
    for path in paths:
        text = read_text_columns(spark, path)
        if bad_cells is not None:
            text = text.observe(bad_cells, *(_unreadable(f).alias(f.name) for f in _checked_fields()))
        part = by_name(text)
        flights = part if flights is None else flights.unionByName(part)
    return flights


def bad_cell_report(spark: SparkSession, path: str) -> DataFrame:
    """Unreadable cells per typed column, one row per column."""
    fields = _checked_fields()
    counts = read_text_columns(spark, path).agg(*(_unreadable(f).alias(f.name) for f in fields))
    return counts.unpivot(
        [], [f.name for f in fields], "columna", "celdas_invalidas"
    )


def write_flights(flights: DataFrame, path: str) -> None:
    """CSV files in the historical column order, one per task."""
    flights.select(*CSV_ORDER).write.option("header", True).csv(path)
