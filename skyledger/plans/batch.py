"""The batch chain: CSV to bronze, bronze to silver, silver to gold.

The layers hand over as tables, so a step can be repeated alone; an exception
in one keeps the next from starting.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.config import LakeConfig
from skyledger.operators import buckets, gold
from skyledger.operators.bronze import rename_flights, stamp_ingestion
from skyledger.operators.gold import monthly_by_airline, monthly_by_route
from skyledger.operators.silver import silver_flights
from skyledger.sources import csv_files, tables

#: Fixed value: the data model's name of the roll-up by airline.
AIRLINE_TABLE = "rendimiento_historico_vuelos"


def ingest(spark: SparkSession, cfg: LakeConfig, csv_path: str) -> dict[str, int]:
    """Loads the bronze table; returns the unreadable cells per column."""
    bad_cells = Observation()
    flights = csv_files.read_flights(spark, csv_path, bad_cells=bad_cells)
    bronze = flights.transform(rename_flights).transform(stamp_ingestion)
    tables.overwrite_table(bronze, cfg.table_name("bronze"), cfg.table_format)
    return bad_cells.get


def transform(spark: SparkSession, cfg: LakeConfig) -> None:
    bronze = tables.read_table(spark, cfg.table_name("bronze"))
    silver, partitions = silver_flights(bronze, cfg.rules), cfg.silver_partitions
    if cfg.flight_buckets:
        silver = buckets.add(silver, cfg.flight_buckets)
        partitions = (buckets.column(cfg.flight_buckets), *partitions)
    tables.overwrite_table(silver, cfg.table_name("silver"), cfg.table_format, partitions)


def load(spark: SparkSession, cfg: LakeConfig) -> None:
    """The monthly results by route and the roll-up by airline."""
    silver = tables.read_table(spark, cfg.table_name("silver"))
    tables.overwrite_table(monthly_by_route(silver), cfg.table_name("gold"), cfg.table_format)
    airlines = cfg.table_name("gold", table=AIRLINE_TABLE)
    tables.overwrite_table(monthly_by_airline(silver), airlines, cfg.table_format)


#: Tables of the incremental results: partial sums by load, and the results by month.
PARTIALS_TABLE, MONTHS_TABLE, AIRLINE_MONTHS_TABLE = "parciales", "vuelos_por_mes", "aerolineas_por_mes"


def load_increment(spark: SparkSession, cfg: LakeConfig, silver: DataFrame, load_id: int) -> list[int]:
    """Adds one load of silver flights to the monthly results; returns the months it
    touched (as year times 100 plus month, 0 for flights without a date).

    Only this load is aggregated, to partial sums that are kept by load. The results of
    the touched months are then added up again from the partial sums of all loads, and
    only these months' partitions are replaced. A load that comes again replaces what it
    added before, the months it has left included.
    """
    partials = cfg.table_name("gold", table=PARTIALS_TABLE)

    def months() -> set[int]:
        if not spark.catalog.tableExists(partials):
            return set()
        mine = spark.table(partials).where(F.col(tables.BATCH_ID) == load_id)
        return {row[0] for row in mine.select(gold.PERIOD).distinct().collect()}

    before = months()
    tables.write_batch(gold.partial_sums(silver), partials, load_id, cfg.table_format)
    touched = sorted(before | months())
    sums = spark.table(partials).where(F.col(gold.PERIOD).isin(touched))
    for table, result in (
        (MONTHS_TABLE, gold.monthly_from_partials(sums)),
        (AIRLINE_MONTHS_TABLE, gold.airlines_from_partials(sums)),
    ):
        name = cfg.table_name("gold", table=table)
        tables.replace_partitions(result, name, gold.PERIOD, touched, cfg.table_format)
    return touched


#: Table property with the load of a table and what it was made from.
MADE_FROM = "skyledger.made_from"


def _files(spark: SparkSession, path: str) -> str:
    """Fingerprint of the names, sizes and times of the files at a path."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    told = files.agg(F.count("*"), F.sum(F.xxhash64(*files.columns).cast("decimal(20,0)"))).first()
    return f"{told[0]} files {told[1]}"


def run(
    spark: SparkSession, cfg: LakeConfig, csv_path: str, *, resume: bool = False
) -> dict[str, int]:
    """All three steps in order, on schemas that are created if missing.

    Each table says which load it is and what that was made from: the input files or the
    load before it, and the parameters. With ``resume`` a step whose table says that it
    is made from exactly this is left out, so a chain that was stopped goes on where it
    was, and a changed input, limit or layout runs all that depends on it. The result is
    empty where the ingestion was left out.
    """
    tables.create_schemas(spark, cfg)
    bronze, silver, result = (cfg.table_name(layer) for layer in ("bronze", "silver", "gold"))
    airlines = cfg.table_name("gold", table=AIRLINE_TABLE)

    def step(work: Callable[[], object], source: str, *made: str) -> object:
        source = hashlib.sha256(source.encode()).hexdigest()

        def mark(name: str) -> str:
            return f"{tables.version(spark, name)} {source}"

        if resume and all(
            tables.property_of(spark, name, MADE_FROM) == mark(name)
            for name in made
            if spark.catalog.tableExists(name)
        ) and all(map(spark.catalog.tableExists, made)):
            return None
        done = work()
        for name in made:
            tables.set_property(spark, name, MADE_FROM, mark(name))
        return done

    layout = f"{cfg.table_format} {cfg.rules}"
    bad_cells = step(lambda: ingest(spark, cfg, csv_path), f"{_files(spark, csv_path)} {cfg.table_format}", bronze)
    shape = f"{layout} {cfg.silver_partitions} {cfg.flight_buckets}"
    step(lambda: transform(spark, cfg), f"{tables.version(spark, bronze)} {shape}", silver)
    step(lambda: load(spark, cfg), f"{tables.version(spark, silver)} {layout}", result, airlines)
    return bad_cells or {}


def schema_report(df: DataFrame) -> list[tuple[str, str, bool]]:
    """Name, type and nullability of each column."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema]


def teardown(
    spark: SparkSession, cfg: LakeConfig, *, tables_to_drop: list[str], paths: list[str] = ()
) -> list[str]:
    """Drops the listed tables, then deletes the listed paths (checkpoints
    included: a stream that restarts on an old one would skip dropped data)."""
    tables.drop_tables(spark, tables_to_drop)
    if not paths:
        return []
    if cfg.root is None:
        raise ValueError("deleting paths needs LakeConfig.root")
    return tables.delete_paths(spark, paths, root=cfg.root)
