"""Tables: create, overwrite, append by batch, remove.

Rows are written once, into a folder of their own below the table's folder, and become
the table's rows by one statement of the catalog: a load moves the table to its new
folder, a batch moves its partition. What a statement leaves behind is marked as retired
and stays readable for ``GRACE_SECONDS``, so a running reader finishes on the rows it
began with. ``sweep`` removes it after that, together with what failed loads left.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameWriter

from skyledger.config import BATCH_LAYERS, STREAM_LAYERS, LakeConfig

BATCH_ID = "batch_id"

#: Seconds for which rows that are not live any more are kept for running readers.
GRACE_SECONDS = 3600
#: How Parquet rows of tables are packed where the session names no codec.
CODEC = "zstd"
#: Mark in a folder that is not live any more. Its name hides it from readers.
RETIRED = "_retired"
#: Ending of a table that is complete and about to take another one's name.
NEXT = "__next"


def create_schemas(spark: SparkSession, cfg: LakeConfig) -> list[str]:
    """The batch and streaming schemas, each at its configured location."""
    layers = [(name, False) for name in BATCH_LAYERS] + [(name, True) for name in STREAM_LAYERS]
    created = []
    for layer, stream in layers:
        schema = cfg.schema(layer, stream=stream)
        place = cfg.location(layer, stream=stream)
        at = f" LOCATION '{place}'" if place else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{at}")
        created.append(schema)
    return created


def drop_schema(spark: SparkSession, schema: str, *, confirm: str) -> None:
    """Drops a schema with all its tables; ``confirm`` must repeat its name."""
    if confirm != schema:
        raise ValueError(f"not dropping {schema}: confirm says {confirm!r}")
    if spark.catalog.databaseExists(schema):
        held = spark.catalog.listTables(schema)
        drop_tables(spark, [f"{schema}.{t.name}" for t in held if not t.isTemporary and t.tableType != "VIEW"])
    spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Drops tables with their rows, retired ones included."""
    for name in names:
        folder = None
        if spark.catalog.tableExists(name) and _by_folder(name):
            folder = table_folder(spark, name)
            if not (location(spark, name) + "/").startswith(folder + "/"):
                folder = None
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        if folder:
            delete_paths(spark, [folder], root=folder.rsplit("/", 1)[0])


def delete_paths(spark: SparkSession, paths: Iterable[str], *, root: str) -> list[str]:
    """Recursive delete of the given paths, each of which must be below ``root``.

    Goes through the Hadoop file system, so it takes any URI Spark can read.
    Returns the paths that existed.
    """
    jvm = spark.sparkContext._jvm
    path_type = jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root_path = path_type(root)
    fs = root_path.getFileSystem(conf)
    base = fs.makeQualified(root_path).toString().rstrip("/") + "/"
    targets = []
    for path in paths:
        target = fs.makeQualified(path_type(path))
        if ".." in path.split("/") or not target.toString().startswith(base):
            raise ValueError(f"{path} is not below {root}")
        targets.append((path, target))
    return [path for path, target in targets if fs.delete(target, True)]


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _by_folder(name: str, fmt: str = "parquet") -> bool:
    """Whether versions are kept in folders: in the session's own catalog, unless the
    format has transactions of its own."""
    return name.count(".") == 1 and fmt != "delta"


def table_folder(spark: SparkSession, name: str) -> str:
    """The folder below which all rows of a table lie, live or not."""
    schema, table = name.split(".")
    return f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{table}"


def location(spark: SparkSession, name: str, partition: str = "") -> str:
    """Where the live rows of a table or of one of its partitions lie."""
    return _fact(spark, name, "Location", partition).rstrip("/")


def _fact(spark: SparkSession, name: str, fact: str, partition: str = "") -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {name} {partition}").collect()
    # Columns come first, and may be called anything.
    start = next(i for i, row in enumerate(rows) if row[0].startswith("# Detailed "))
    return next(row[1] for row in rows[start:] if row[0] == fact)


def version(spark: SparkSession, name: str) -> str:
    """Name of the load that a table's rows come from."""
    return location(spark, name).rsplit("/", 1)[-1]


def snapshot(spark: SparkSession, name: str) -> tuple[str, DataFrame]:
    """A table's load and its rows, which stay those of that load whatever comes later."""
    if not _by_folder(name) or _fact(spark, name, "Provider").lower() == "delta":
        spark.catalog.refreshTable(name)
        return "", spark.table(name)
    spark.catalog.refreshTable(name)
    place, schema = location(spark, name), spark.table(name).schema
    rows = spark.read.format(_fact(spark, name, "Provider")).schema(schema).load(place)
    return place.rsplit("/", 1)[-1], rows.select(*schema.fieldNames())


def _stamp() -> str:
    return f"v{time.time_ns() // 1_000_000:013d}_{uuid.uuid4().hex[:8]}"


def is_load(version: str) -> bool:
    """Whether a version names one load, whose rows are what they were when it went live."""
    return re.fullmatch(r"v\d{13}_[0-9a-f]{8}", version) is not None


def _retire(spark: SparkSession, place: str) -> None:
    fs, target = _hadoop(spark, f"{place}/{RETIRED}")
    if fs.exists(target.getParent()):
        fs.createNewFile(target)


def sweep(spark: SparkSession, name: str, grace_seconds: float = GRACE_SECONDS) -> list[str]:
    """Removes folders of a table that have been retired for the grace period; returns them.

    A folder that is neither live nor marked is a load under way or the rest of one that
    failed. Once it is older than the period it is marked, and so goes one period later;
    the period must be longer than a load and than a reader takes.
    """
    if not _by_folder(name) or not spark.catalog.tableExists(name):
        return []
    folder = table_folder(spark, name)
    fs, base = _hadoop(spark, folder)
    if not fs.exists(base):
        return []
    now = time.time() * 1000
    live = {location(spark, name)}
    batches = set(batch_ids(spark, name)) if BATCH_ID in spark.table(name).columns else set()
    keyed = not batches and location(spark, name) == folder
    removed = []
    for status in fs.listStatus(base):
        child = status.getPath().getName()
        stamp = child.rsplit("-", 1)[-1]
        if not (status.isDirectory() and stamp.startswith("v") and "_" in stamp):
            continue
        place = f"{folder}/{child}"
        if child.startswith(f"{BATCH_ID}="):
            number = int(child.split("=", 1)[1].rsplit("-", 1)[0])
            if number in batches and location(spark, name, _partition(number)).endswith("/" + child):
                continue
        elif any(at.endswith("/" + child) for at in live):
            continue
        elif keyed:
            parts = [p for p in fs.listStatus(status.getPath()) if p.isDirectory()]
            removed += _sweep_parts(spark, name, place, parts, now, grace_seconds)
            continue
        mark = _hadoop(spark, f"{place}/{RETIRED}")[1]
        if fs.exists(mark):
            if now - fs.getFileStatus(mark).getModificationTime() >= grace_seconds * 1000:
                fs.delete(status.getPath(), True)
                removed.append(place)
        elif now - int(stamp[1:].split("_")[0]) >= grace_seconds * 1000:
            fs.createNewFile(mark)
    return removed


def _sweep_parts(spark: SparkSession, name: str, place: str, parts, now: float, grace_seconds: float) -> list[str]:
    """The retired partitions of one change of ``replace_partitions``."""
    held = {row[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    removed = []
    for status in parts:
        child = status.getPath().getName()
        at = f"{place}/{child}"
        key, value = child.split("=", 1)
        tail = "/".join(at.rsplit("/", 2)[1:])
        if child in held and location(spark, name, f"PARTITION (`{key}` = {value})").endswith("/" + tail):
            continue
        fs, mark = _hadoop(spark, f"{at}/{RETIRED}")
        if fs.exists(mark):
            if now - fs.getFileStatus(mark).getModificationTime() >= grace_seconds * 1000:
                fs.delete(status.getPath(), True)
                removed.append(at)
        elif now - status.getModificationTime() >= grace_seconds * 1000:
            fs.createNewFile(mark)
    return removed


def _ddl(fields: Iterable[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _shape(fields: Iterable[T.StructField]) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in fields]


def _finish_replacing(spark: SparkSession, name: str) -> None:
    """Completes a replacement that was stopped between dropping the old table and giving
    its name to the new one; forgets one that was stopped before that."""
    waiting = name + NEXT
    if not _by_folder(name) or not spark.catalog.tableExists(waiting):
        return
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE IF EXISTS {waiting}")
    else:
        spark.sql(f"ALTER TABLE {waiting} RENAME TO {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    try:
        return spark.table(name)
    except AnalysisException:
        _finish_replacing(spark, name)
        return spark.table(name)


def _writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    """Writer of a folder of table rows, in ``CODEC`` unless the session names another."""
    writer = df.write.format(fmt)
    if fmt == "parquet" and not df.sparkSession.conf.get("spark.sql.parquet.compression.codec", None):
        return writer.option("compression", CODEC)
    return writer


def overwrite_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Iterable[str] = (),
    grace_seconds: float = GRACE_SECONDS,
    gather: bool = True,
) -> None:
    """Replaces the rows of a table, and its columns where they differ.

    The new rows are written to a folder of their own first; a load that fails leaves the
    old ones. Then one statement moves the table there. Where that cannot be one statement
    (other columns, or partitions, which the catalog lists one by one) a complete table is
    created beside the old one and takes its name; if that is stopped halfway, the next
    ``read_table`` or load completes it. Delta replaces a table in one transaction.

    Without partitions every task writes its own rows and nothing is shuffled.
    With them, rows are gathered by partition value first, so that a partition
    is not scattered over as many files as there are tasks; the rebalance hint
    lets adaptive execution cut an oversized value into several tasks. With
    ``gather=False`` a task sorts its own rows by partition value and writes a file
    for each: for a few values that all tasks have alike, such as parts by a hash,
    where gathering would put the whole table on the executors' disks once more.
    """
    columns = list(partition_by)
    if columns and gather:
        df = df.hint("rebalance", *columns)
    spark, by_folder = df.sparkSession, _by_folder(name, fmt)
    writer = (_writer(df, fmt) if by_folder else df.write.format(fmt)).mode("overwrite")
    if columns:
        writer = writer.partitionBy(*columns)
    if not by_folder:
        writer.saveAsTable(name)
        return
    _finish_replacing(spark, name)
    folder = table_folder(spark, name)
    place = f"{folder}/{_stamp()}"
    try:
        writer.save(place)
    except Exception:
        delete_paths(spark, [place], root=folder)
        raise
    last = {c.lower() for c in columns}
    data = [f for f in df.schema if f.name.lower() not in last]
    keys = [f for c in columns for f in df.schema if f.name.lower() == c.lower()]
    _make_live(spark, name, fmt, place, data, keys)
    sweep(spark, name, grace_seconds)


def _make_live(
    spark: SparkSession, name: str, fmt: str, place: str, data: list[T.StructField], keys: list[T.StructField]
) -> None:
    def create(table: str) -> None:
        parts = f"PARTITIONED BY ({', '.join(f'`{f.name}`' for f in keys)})" if keys else ""
        spark.sql(f"CREATE TABLE {table} ({_ddl([*data, *keys])}) USING {fmt} {parts} LOCATION '{place}'")
        if keys:
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")

    if not spark.catalog.tableExists(name):
        create(name)
        return
    before = location(spark, name)
    stored = spark.catalog.listColumns(name)
    old = list(spark.table(name).schema)
    known = len(old)
    whole = not keys and not any(c.isPartition for c in stored)
    same_kind = _fact(spark, name, "Provider").lower() == fmt.lower()
    if whole and same_kind and _shape(old) == _shape(data[:known]):
        if len(data) > known:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(data[known:])})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    else:
        create(name + NEXT)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {name}{NEXT} RENAME TO {name}")
    _retire(spark, before)


def settle(df: DataFrame, path: str) -> DataFrame:
    """Writes an intermediate result to shared storage and reads it back.

    For a result that is much smaller than its input and is joined afterwards:
    the planner then knows its real size, so its broadcast check decides on the
    result and not on the input it came from, and an executor lost during the
    join does not cause the result to be computed again.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _partition(batch_id: int) -> str:
    return f"PARTITION (`{BATCH_ID}` = {int(batch_id)})"


def _fitted(field: T.StructField, kind: T.DataType) -> Column:
    """A column as the table stores it; a value that does not fit is an error."""
    column = F.col(f"`{field.name}`")
    if field.dataType.simpleString() == kind.simpleString():
        return column
    fitted = column.try_cast(kind)
    lost = F.raise_error(F.concat(F.lit(f"no {kind.simpleString()} for {field.name}: "), column.cast("string")))
    return F.when(column.isNotNull() & fitted.isNull(), lost.cast(kind)).otherwise(fitted).alias(field.name)


def write_batch(df: DataFrame, name: str, batch_id: int, fmt: str = "parquet") -> None:
    """Appends one micro-batch as the partition ``batch_id`` of a table.

    The rows are written once, to a folder of their own, with the types the table has;
    then one statement makes that folder the partition. So a batch that is replayed
    after a failure is in the table once, and a replay that fails, for whatever reason,
    leaves the batch as it was. Columns that the table lacks are added to it; earlier
    batches have NULL there. A batch without one of the table's columns is an error.
    """
    spark = df.sparkSession
    if not _by_folder(name, fmt):
        rows = df.withColumn(BATCH_ID, F.lit(int(batch_id)).cast("bigint"))
        rows.write.format(fmt).mode("overwrite").partitionBy(BATCH_ID).option("mergeSchema", "true").option(
            "replaceWhere", f"{BATCH_ID} = {int(batch_id)}"
        ).saveAsTable(name)
        return
    folder = table_folder(spark, name)
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(df.schema)}, `{BATCH_ID}` BIGINT) "
            f"USING {fmt} PARTITIONED BY (`{BATCH_ID}`) LOCATION '{folder}'"
        )
    stored = {f.name.lower(): f.dataType for f in spark.table(name).schema if f.name != BATCH_ID}
    missing = stored.keys() - {c.lower() for c in df.columns}
    if missing:
        raise ValueError(f"batch {batch_id} lacks columns of {name}: {', '.join(sorted(missing))}")
    rows = df.select(*(_fitted(f, stored.get(f.name.lower(), f.dataType)) for f in df.schema))
    place = f"{folder}/{BATCH_ID}={int(batch_id)}-{_stamp()}"
    try:
        _writer(rows, fmt).save(place)
    except Exception:
        delete_paths(spark, [place], root=folder)
        raise
    new = [f for f in df.schema if f.name.lower() not in stored]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(new)})")
    part = _partition(batch_id)
    if int(batch_id) in batch_ids(spark, name):
        before = location(spark, name, part)
        spark.sql(f"ALTER TABLE {name} {part} SET LOCATION '{place}'")
        _retire(spark, before)
    else:
        spark.sql(f"ALTER TABLE {name} ADD {part} LOCATION '{place}'")


def replace_partitions(
    df: DataFrame, name: str, key: str, values: Iterable[int], fmt: str = "parquet"
) -> None:
    """Replaces the partitions ``values`` of a whole-number column ``key``, and no other.

    The rows, which must be of these partitions, are written once below a folder of this
    change; then each partition moves there by one statement, and one that has no rows
    any more is dropped. A change that is stopped halfway is completed by running it again.
    """
    spark = df.sparkSession
    folder = table_folder(spark, name)
    if not spark.catalog.tableExists(name):
        fields = [f for f in df.schema if f.name != key]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(fields)}, `{key}` INT) "
            f"USING {fmt} PARTITIONED BY (`{key}`) LOCATION '{folder}'"
        )
    place = f"{folder}/{_stamp()}"
    try:
        df.hint("rebalance", key).write.format(fmt).partitionBy(key).save(place)
    except Exception:
        delete_paths(spark, [place], root=folder)
        raise
    held = {int(row[0].split("=", 1)[1]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    fs, written = _hadoop(spark, place)
    names = [p.getPath().getName() for p in fs.listStatus(written) if p.isDirectory()]
    filled = {int(n.split("=", 1)[1]) for n in names}
    asked = {int(v) for v in values}

    def part(value: int) -> str:
        return f"PARTITION (`{key}` = {value})"

    new = [f"{part(v)} LOCATION '{place}/{key}={v}'" for v in sorted(filled - held)]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(new)}")
    for value in sorted(filled & held):
        spark.sql(f"ALTER TABLE {name} {part(value)} SET LOCATION '{place}/{key}={value}'")
    empty = sorted((asked - filled) & held)
    if empty:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(part, empty))}")


def property_of(spark: SparkSession, name: str, key: str) -> str | None:
    """A table property; None where it, or the table, is missing."""
    if not spark.catalog.tableExists(name):
        return None
    found = {row[0]: row[1] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return found.get(key)


def set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{key}' = '{value}')")


def batch_ids(spark: SparkSession, name: str) -> list[int]:
    """Batches a table holds, from the catalog (no data is read)."""
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return sorted(int(row[0].split("=", 1)[1]) for row in rows)


def drop_batches(spark: SparkSession, name: str, ids: Iterable[int]) -> None:
    """Takes batches out of a table, by one statement; ``sweep`` removes their rows."""
    held = set(batch_ids(spark, name))
    ids = [int(i) for i in ids if int(i) in held]
    if not ids:
        return
    places = [location(spark, name, _partition(i)) for i in ids] if _by_folder(name) else []
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(_partition, ids))}")
    for place in places:
        _retire(spark, place)
