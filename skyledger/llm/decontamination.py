"""Benchmark decontamination: a prefix-filtered set join of item windows.

A window is a run of ``WINDOW`` consecutive item words, or all words of a shorter
item, and stands for the set of its word shingles. A text contains a window only
if it contains all its shingles, so the necessary prefix of each set is one
shingle, the rarest; texts are joined on that shingle only. A match fixes where
the window would begin: positional and length bounds drop what would leave the
text, and the rest is compared word by word.

Windows, prefixes and matches are tables, and the join is a shuffle unless Spark's
size check finds one side small. What every task gets has a fixed size: shingle
counts in ``CELLS`` hash cells, which order shingles by rarity over all documents
(sharing a cell can make a choice worse, not wrong), and a bit for each of
``FILTER_BITS`` hash cells that hold a prefix, which keeps most places of clean
texts out of the join. A shingle with many occurrences is dealt to one task for
each ``SALT_ROWS`` of them. Copies of a text ask once per task, and results belong
to the text, so all its copies share them.

A null text has no words and a null item no windows; an empty text has no words
and is clean; an empty benchmark hits nothing, no documents give no rows. Texts of
any length are read whole; their places leave a task in batches of
``ROWS_AT_ONCE``. Repeated rows each have their result. Repeated items and items
that share windows are all found, a null ``item_id`` as the empty string. Columns
other than ``doc_id``, ``text``, ``item_id`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.llm.common import (
    ROWS_AT_ONCE, Scratch, Shared, WordHashes, as_bytes, counted, fresh, ngrams, text_key,
)

WINDOW = 13
#: Words in a shingle; an item of fewer words is one shingle.
SHINGLE = 3
#: Hash cells in which occurrences of shingles are counted, and of the prefix filter.
CELLS, FILTER_BITS = 1 << 20, 1 << 23
#: Expected occurrences of one prefix that one task joins.
SALT_ROWS = 100_000

# Lower-cases A-Z; blanks for the other ASCII characters that separate words.
FOLDED = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32
    for c in range(256)
)


def item_words(text: bytes | None) -> list[bytes]:
    return text.translate(FOLDED).split() if text else []


def _shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each place that begins ``width`` words."""
    return ngrams(hashes ^ np.uint64(width), width)


def _cell(keys: np.ndarray) -> np.ndarray:
    return (keys % np.uint64(CELLS)).astype(np.int64)


def _bit(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _salts(counts: np.ndarray) -> np.ndarray:
    return 1 + counts // SALT_ROWS


def _emit(df: DataFrame, schema: str, rows) -> DataFrame:
    """What ``rows``, called once per task, yields for each batch, in batches of bounded size."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def packed(out: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, out = rows(), []
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                for row in work(batch.slice(at, ROWS_AT_ONCE)):
                    out.append(row)
                    if len(out) == ROWS_AT_ONCE:
                        yield packed(out)
                        out = []
        if out:
            yield packed(out)

    return df.mapInArrow(run, schema)


def _windows(benchmark: DataFrame) -> DataFrame:
    """The distinct windows and the items that have them: ``words, items``."""

    def rows():
        def work(batch: pa.RecordBatch):
            for item, text in zip(batch.column("item").to_pylist(), as_bytes(batch)):
                words = item_words(text)
                for start in range(max(1, len(words) - WINDOW + 1) if words else 0):
                    yield words[start : start + WINDOW], item

        return work

    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    found = _emit(benchmark.select(item, "text"), "words array<binary>, item string", rows)
    return found.groupBy("words").agg(F.collect_set("item").alias("items"))


class _ShingleCount:
    """Occurrences of shingles of the given widths, in the cells that windows use."""

    def __init__(self, widths: list[int], used: np.ndarray):
        self.widths, self.used = widths, used
        self.hashes, self.total = WordHashes(), np.zeros(CELLS, np.int64)

    def __call__(self, batch: pa.RecordBatch) -> None:
        for text in as_bytes(batch):
            hashes = self.hashes.of(item_words(text))
            for width in self.widths:
                cells = _cell(_shingles(hashes, width))
                np.add.at(self.total, cells[self.used[cells]], 1)


def _rarity(docs: DataFrame, windows: DataFrame) -> tuple[list[int], np.ndarray]:
    """Shingle widths of the windows, and occurrences in the corpus by cell."""

    def rows():
        hashes = WordHashes()

        def work(batch: pa.RecordBatch):
            for words in batch.column("words").to_pylist():
                width = min(len(words), SHINGLE)
                for cell in np.unique(_cell(_shingles(hashes.of(words), width))).tolist():
                    yield width, cell

        return work

    cells = _emit(windows.select("words"), "width int, cell long", rows).distinct().toArrow()
    widths = sorted(set(cells["width"].to_pylist()))
    if not widths:
        return widths, np.zeros(CELLS, np.int64)
    used = np.zeros(CELLS, bool)
    used[cells["cell"].to_numpy()] = True
    shared = Shared(docs.sparkSession, (widths, used))
    counts = counted(docs.select("text"), CELLS, lambda: _ShingleCount(*shared.load()))
    shared.destroy()
    return widths, counts


def _prefixes(windows: DataFrame, rarity: Shared) -> DataFrame:
    """The windows with the key of their rarest shingle and its place, without those
    that have a shingle no text has."""

    def rows():
        counts, hashes = rarity.load(), WordHashes()

        def work(batch: pa.RecordBatch):
            for words, items in zip(batch.column("words").to_pylist(), batch.column("items").to_pylist()):
                keys = _shingles(hashes.of(words), min(len(words), SHINGLE))
                n = counts[_cell(keys)]
                at = int(n.argmin())
                if n[at]:
                    key = keys[at : at + 1]
                    yield int(key.view(np.int64)[0]), int(_bit(key)[0]), int(_salts(n[at])), at, words, items

        return work

    schema = "key long, bit long, salts long, offset int, words array<binary>, items array<string>"
    return _emit(windows, schema, rows)


class _Asker:
    """Rows of a text: one with its size, and one for each place that may be a prefix."""

    def __init__(self, widths: list[int], bits: np.ndarray, counts: np.ndarray, sizes: bool):
        self.widths, self.bits, self.counts, self.sizes = widths, bits, counts, sizes
        self.hashes, self.asked = WordHashes(), set()

    def _places(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for width in self.widths:
            keys = _shingles(hashes, width)
            bit = _bit(keys)
            at = np.flatnonzero(self.bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
            if len(at):
                yield width, at, keys[at]

    def __call__(self, batch: pa.RecordBatch):
        for doc, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch)):
            words = item_words(text)
            places = list(self._places(self.hashes.of(words)))
            key = hashlib.md5(text).digest() if places else None
            if self.sizes:
                yield doc, len(words), key, None, None, None, None, None
            if places and key not in self.asked:
                self.asked.add(key)
                for width, at, keys in places:
                    yield from self._asked(words, key, width, at, keys)

    def _asked(self, words: list[bytes], text: bytes, width: int, at: np.ndarray, keys: np.ndarray):
        salts = (at % _salts(self.counts[_cell(keys)])).tolist()
        rows = zip(at.tolist(), keys.view(np.int64).tolist(), salts)
        if width == SHINGLE:  # the window may reach this far to both sides
            reach = WINDOW - SHINGLE
            for p, key, salt in rows:
                low = max(0, p - reach)
                yield None, len(words), text, key, salt, p - low, words[low : p + WINDOW], [p]
        else:  # the window is the shingle
            same: dict[tuple, list[int]] = {}
            for p, key, salt in rows:
                same.setdefault((key, salt, *words[p : p + width]), []).append(p)
            for (key, salt, *shingle), found in same.items():
                for i in range(0, len(found), ROWS_AT_ONCE):
                    yield None, len(words), text, key, salt, 0, shingle, found[i : i + ROWS_AT_ONCE]


ASKED = (
    "doc_id long, n_words long, text_key binary, key long, salt long, before int, "
    "context array<binary>, places array<long>"
)


def _n_covered(runs: F.Column) -> F.Column:
    """Words inside any of the runs ``(start, n)``."""
    zero = F.lit(0).cast("long")

    def step(acc, run):
        end = run["start"] + run["n"]
        more = F.greatest(zero, end - F.greatest(acc["end"], run["start"]))
        return F.struct((acc["total"] + more).alias("total"), F.greatest(acc["end"], end).alias("end"))

    first = F.struct(zero.alias("total"), zero.alias("end"))
    return F.aggregate(F.array_sort(runs), first, step, lambda acc: acc["total"])


def _found(asked: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Texts that hold windows: ``text_key, n_words, n_hit, items``."""
    dealt = prefixes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    n, begin = F.size("words"), F.col("before") - F.col("offset")
    inside = (begin >= 0) & (begin + n <= F.size("context"))
    pairs = asked.where(F.col("key").isNotNull()).join(dealt, ["key", "salt"]).where(inside)
    same = pairs.where(F.slice("context", F.greatest(begin, F.lit(0)) + 1, n) == F.col("words"))
    runs = F.transform(
        "places", lambda p: F.struct((p - F.col("offset")).alias("start"), n.cast("long").alias("n"))
    )
    by_text = same.groupBy("text_key").agg(
        F.max("n_words").alias("n_words"),
        F.collect_set(runs).alias("runs"),
        F.collect_set("items").alias("items"),
    )
    return by_text.select(
        "text_key",
        "n_words",
        _n_covered(F.flatten("runs")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
    )


def _join(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, sizes: bool) -> tuple[DataFrame, DataFrame]:
    """The rows that texts ask with, and the texts found."""
    spark = docs.sparkSession
    windows = scratch.keep(_windows(benchmark), "windows")
    widths, counts = _rarity(docs, windows)
    rarity = Shared(spark, counts)
    prefixes = scratch.keep(_prefixes(windows, rarity), "prefixes")
    bits = np.zeros(FILTER_BITS, np.uint8)
    bits[prefixes.select("bit").distinct().toArrow()["bit"].to_numpy()] = 1
    shared = Shared(spark, (widths, np.packbits(bits, bitorder="little"), counts, sizes))
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    asked = scratch.keep(_emit(texts, ASKED, lambda: _Asker(*shared.load())), "asked")
    found = scratch.keep(_found(asked, prefixes), "found")
    scratch.drop("windows", "prefixes")
    rarity.destroy()
    shared.destroy()
    return asked, found


def _contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` (sorted ids) and ``contaminated`` per row."""
    asked, found = _join(docs, benchmark, Scratch(docs.sparkSession, "benchmark"), True)
    sizes = asked.where(F.col("key").isNull()).select("doc_id", "n_words", "text_key")
    none = F.array().cast("array<string>")
    # Most rows asked for nothing and need no join; their keys are null.
    clean = sizes.where(F.col("text_key").isNull()).select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items")
    )
    others = sizes.where(F.col("text_key").isNotNull()).join(found.drop("n_words"), "text_key", "left")
    others = others.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
    )
    return clean.unionByName(others).withColumn("contaminated", _contaminated())


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated, unchanged."""
    scratch = Scratch(docs.sparkSession, "benchmark")
    _, found = _join(docs, benchmark, scratch, False)
    (name,) = fresh(docs, "text_key")
    dirty = scratch.keep(found.where(_contaminated()).select(F.col("text_key").alias(name)), "dirty")
    scratch.drop("asked", "found")
    # Null texts are spread by their ids, so that a shuffle does not gather them.
    key = F.coalesce(text_key(F.col("text")), F.unhex(F.hex(F.xxhash64("doc_id"))))
    return docs.withColumn(name, key).join(dirty, name, "left_anti").select(*docs.columns)
