"""Run parameters: where the tables live and which business limits apply."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, fields
from decimal import Decimal

from pyspark.sql import SparkSession

# Layers created for the batch side and for the streaming side.
BATCH_LAYERS = ("bronze", "silver", "gold", "exploratory")
STREAM_LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Rules:
    """Business limits used by the silver and tracking steps."""

    low_cost_limit: Decimal = Decimal("400.00")
    high_capacity_seats: int = 300
    miles_per_km: float = 0.621371
    # Smallest delay a late flight can have, and the delay that counts as high.
    min_delay: int = 15
    high_delay: int = 60

    @classmethod
    def from_session(cls, spark: SparkSession) -> Rules:
        """Limits set as ``spark.skyledger.rules.<field>`` in the session."""
        found = {}
        for one in fields(cls):
            text = spark.conf.get(f"spark.skyledger.rules.{one.name}", None)
            if text is not None:
                found[one.name] = type(one.default)(text)
        return cls(**found)


@dataclass(frozen=True)
class Horizon:
    """How long flights stay in the current state, by the clock of the events.

    The clock is the newest event time of all batches so far. A landed or cancelled flight
    leaves ``finished`` after its last event, any other one ``silent`` after it (never, if
    None). An event that is older than the clock before its batch by more than
    ``finished`` is late and not taken. So no event that is taken is older than what has
    left, and the answer does not depend on when the log was compacted.
    """

    finished: dt.timedelta
    silent: dt.timedelta | None = None

    def __post_init__(self):
        if self.silent is not None and self.silent < self.finished:
            raise ValueError("silent flights must stay at least as long as finished ones")


@dataclass(frozen=True)
class LakeConfig:
    """Names and locations of one environment.

    ``root`` is a folder every executor can reach (``abfss://``, ``s3a://``,
    ``hdfs://`` ...); each schema gets a folder below it, and so do the stream
    checkpoints. With ``root=None`` schemas use the session's warehouse folder.

    ``three_part_names`` is for catalogs that take ``catalog.schema.table``;
    Spark's built-in catalog takes ``schema.table`` only, so there the catalog
    name becomes a prefix of the schema name.
    """

    catalog: str = "dev"
    stream_catalog: str = "streaming"
    root: str | None = None
    table: str = "vuelos"
    table_format: str = "parquet"
    three_part_names: bool = False
    silver_partitions: tuple[str, ...] = ()
    # Parts the history is stored in by a hash of the flight id; 0 for none.
    flight_buckets: int = 0
    rules: Rules = field(default_factory=Rules)

    @classmethod
    def from_session(cls, spark: SparkSession, **overrides) -> LakeConfig:
        """Values set as ``spark.skyledger.<field>`` in the session; arguments
        win over them."""
        found = {}
        for name, kind in (
            ("catalog", str), ("stream_catalog", str), ("root", str), ("table", str),
            ("table_format", str), ("three_part_names", bool), ("silver_partitions", tuple),
            ("flight_buckets", int),
        ):
            text = spark.conf.get(f"spark.skyledger.{name}", None)
            if text is None:
                continue
            if kind is bool:
                found[name] = text.lower() == "true"
            elif kind is tuple:
                found[name] = tuple(part.strip() for part in text.split(",") if part.strip())
            elif kind is int:
                found[name] = int(text)
            else:
                found[name] = text
        if "rules" not in overrides:
            found["rules"] = Rules.from_session(spark)
        return cls(**{**found, **overrides})

    def schema(self, layer: str, *, stream: bool = False) -> str:
        catalog = self.stream_catalog if stream else self.catalog
        return f"{catalog}.{layer}" if self.three_part_names else f"{catalog}_{layer}"

    def table_name(self, layer: str, *, stream: bool = False, table: str | None = None) -> str:
        return f"{self.schema(layer, stream=stream)}.{table or self.table}"

    def location(self, layer: str, *, stream: bool = False) -> str | None:
        if self.root is None:
            return None
        side = self.stream_catalog if stream else self.catalog
        return f"{self.root.rstrip('/')}/{side}/{layer}"

    def checkpoint(self, name: str) -> str:
        if self.root is None:
            raise ValueError("a stream checkpoint needs LakeConfig.root")
        return f"{self.root.rstrip('/')}/checkpoints/{name}"
