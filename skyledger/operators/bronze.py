"""Source flights to bronze flights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.schemas import BRONZE_NAMES, REQUIRED_SOURCE


def rename_flights(source: DataFrame) -> DataFrame:
    """The thirteen source columns under their bronze names."""
    return source.select(*(F.col(old).alias(new) for old, new in BRONZE_NAMES.items()))


def stamp_ingestion(flights: DataFrame) -> DataFrame:
    """Adds the load time; one value for the whole query."""
    return flights.withColumn("ingestion_date", F.current_timestamp())


def require_present(source: DataFrame, columns: tuple[str, ...] = REQUIRED_SOURCE) -> DataFrame:
    """Drops rows in which a required column is NULL (off unless called)."""
    return source.dropna(how="any", subset=list(columns))
