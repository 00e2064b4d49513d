"""What the operators share: words, hashes, Arrow passes, folds, scratch tables."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.session import shared_scratch
from skyledger.sources.tables import delete_paths, settle

#: Words a WordHashes table remembers before it starts anew.
KNOWN_WORDS = 1 << 19

#: Rows of an Arrow batch whose texts are Python objects at the same time.
ROWS_AT_ONCE = 1024

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word (bytes) to 64-bit hash; remembers a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` consecutive words; none for shorter texts."""
    m = len(hashes) - n + 1
    if m <= 0:
        return hashes[:0]
    x = hashes[:m].copy()
    for j in range(1, n):
        x *= MULTIPLIER
        x += hashes[j : j + m]
    return mixed(x)


def covered(starts: np.ndarray, lengths: int | np.ndarray, n: int) -> np.ndarray:
    """Mask of the ``n`` positions inside any run that begins at ``starts``."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def repeated(values: np.ndarray) -> np.ndarray:
    """Mask of the values that occur more than once."""
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def as_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """A text column as UTF-8, which splits into words without decoding."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def runs_of(texts: list[bytes | None], size: int) -> Iterator[slice]:
    """Consecutive texts of about ``size`` bytes together, at least one each."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text or b"")
        if total >= size or i == len(texts) - 1:
            yield slice(start, i + 1)
            start, total = i + 1, 0


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null for a null text."""
    return F.unhex(F.md5(text.cast("binary")))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def row_pass(
    df: DataFrame,
    schema: str,
    start: Callable[[], Callable[[pa.RecordBatch], dict]],
    finish: Callable[[Callable], dict | None] | None = None,
) -> DataFrame:
    """Rows computed in Python workers, batch by batch.

    ``start`` is called once per task; what it returns turns a batch into columns
    by name (a column it leaves out is the batch's own). ``finish`` turns that
    object into the last rows of the task, for sums over all its batches.
    """
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def shaped(columns: dict, batch: pa.RecordBatch | None) -> pa.RecordBatch:
        arrays = []
        for field in arrow:
            if field.name in columns:
                value = columns[field.name]
                arrays.append(value if isinstance(value, pa.Array) else pa.array(value, field.type))
            else:
                arrays.append(batch.column(field.name))
        return pa.RecordBatch.from_arrays(arrays, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in _slices(batches):
            columns = work(batch)
            if columns is not None:
                yield shaped(columns, batch)
        if finish is not None:
            columns = finish(work)
            if columns is not None:
                yield shaped(columns, None)

    return df.mapInArrow(run, schema)


def row_filter(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], list]]) -> DataFrame:
    """The rows, all columns unchanged, for which a function of the batch is true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in _slices(batches):
            yield batch.filter(pa.array(work(batch), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def counted(df: DataFrame, size: int, start: Callable) -> np.ndarray:
    """Sums an integer histogram of fixed ``size`` over all rows.

    ``start`` gives a function that adds a batch to its ``total``; each task
    sends its cells that are not zero, and Spark adds them up. What reaches the
    driver is bounded by ``size``.
    """

    def finish(work) -> dict:
        cells = np.flatnonzero(work.total)
        return {"cell": cells, "n": work.total[cells]}

    rows = row_pass(df, "cell long, n long", start, finish)
    cells = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size, np.int64)
    total[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return total


def fold(column: Column, folds: int) -> Column:
    """Remainder of the CRC of an id written as text; null ids as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int
) -> DataFrame:
    """Texts with a 0/1 ``y``, at most ``rows`` labelled ids, never of the held-out fold.

    The ids with the lowest hashes are taken, so the sample is the same in every
    run. An id labelled both ways counts as 1. Being bounded, the sample is
    broadcast and the texts are not shuffled.
    """
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isNotNull())
        .where(fold(F.col("id"), folds) != held_out)
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("id"), "text").where(F.col("text").isNotNull())
    return texts.join(F.broadcast(known), "id").select("text", "y")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the frame already has such a column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


class Shared:
    """A broadcast object of this subpackage. It travels as bytes that hold its class
    too, so workers need not import the package; ``load`` is for once per task."""

    def __init__(self, spark: SparkSession, value: object):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def load(self):
        return pickle.loads(self._bytes.value)

    def destroy(self) -> None:
        self._bytes.destroy()


class Scratch:
    """Intermediate tables in the folder that all executors share."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, shared_scratch(spark, label)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Writes a table and reads it back; cuts the lineage."""
        return settle(df, f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        delete_paths(self.spark, [f"{self.root}/{n}" for n in names], root=self.root)
        self.free()

    def free(self) -> None:
        """Lets Spark remove shuffle files that no frame refers to any more; it does so
        when the driver collects garbage, which a long query may put off too long."""
        self.spark.sparkContext._jvm.System.gc()
