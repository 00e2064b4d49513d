"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text form a group and stay together. Groups, largest first, enter
the shard with the least remaining capacity that holds them, found in a balanced
tree of the shards by remaining capacity; if none holds them, a shard is opened.
For a wanted number of shards the least capacity that needs no more is searched
for, which makes the sizes near equal.

Packing is sequential, but groups of equal size are interchangeable, so sizes and their
counts are packed: as many of a size at once as the tightest shard holds. Sizes that add
up to ``n`` bytes have at most ``sqrt(2 n)`` different values, which is what the driver
sees. Every group then takes its shard by its number among the groups of its size, so
the shards are those of packing one group after the other, at every size of the input.
Groups of at least ``1 / (FINE * shards)`` of all bytes, of which there are at most that
many, are broadcast with their shard, so that no large group is one task.

Size: UTF-8 bytes and 1. Null texts are one group of size 1 per row; empty texts
are another. Very long texts are groups like others; one larger than a shard makes its
shard larger. Of equally large groups the one with the lower digest comes first, of
equally free shards the one with the lower number. An empty table gives no rows. Repeated
rows get slots of their own. Other columns are ignored or, in ``sharded_rows``, passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.llm.common import Scratch, fresh, text_key

#: Share of a shard from which on a group is broadcast with its shard.
FINE = 256
#: Cells in which the rows of a shard, and the groups of a size, are numbered.
SLOT_CELLS = RANK_CELLS = 1024


class FreeSpace:
    """Shards by remaining capacity: a treap whose priorities are hashed from the
    shard number, so it is balanced and the same in every run."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _priority(shard: int) -> int:
        x = (shard + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
        return (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1

    def _split(self, node, key):
        """Nodes below the key, and the others."""
        if node is None:
            return None, None
        own, priority, low, high = node
        if own < key:
            a, b = self._split(high, key)
            return (own, priority, low, a), b
        a, b = self._split(low, key)
        return a, (own, priority, b, high)

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return a[0], a[1], a[2], self._merge(a[3], b)
        return b[0], b[1], self._merge(a, b[2]), b[3]

    def add(self, free: int, shard: int) -> None:
        low, high = self._split(self.root, (free, shard))
        self.root = self._merge(self._merge(low, ((free, shard), self._priority(shard), None, None)), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the shard with the least capacity of at least ``size``."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            return None
        node = high
        while node[2] is not None:
            node = node[2]
        below, others = self._split(high, (node[0][0], node[0][1] + 1))
        self.root = self._merge(low, others)
        return node[0]


def pack_counts(sizes: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int, int]] | None:
    """Best fit in decreasing order of ``(size, count)``: runs ``size, first, n, shard`` of
    the groups of a size, by number. None once more than ``most`` shards are opened."""
    space, runs, opened = FreeSpace(), [], 0
    for size, count in sorted(sizes, reverse=True):
        done = 0
        while done < count:
            if found := space.take(size):
                free, shard = found
            else:
                free, shard = max(capacity, size), opened
                opened += 1
                if most is not None and opened > most:
                    return None
            # Once it holds one, it stays the tightest until it holds no more.
            n = min(count - done, free // size)
            runs.append((size, done, n, shard))
            space.add(free - n * size, shard)
            done += n
    return runs


def pack_into(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Runs in at most ``shards`` shards, by the least capacity found (to one in ten
    thousand)."""
    if not sizes:
        return []
    largest = max(size for size, _ in sizes)
    mean = -(-sum(size * count for size, count in sizes) // shards)
    # Were a shard too many opened, all would hold more than the mean.
    low, high = max(mean, largest), mean + largest
    best, high = pack_counts(sizes, high), high - 1
    while high - low > mean // 10_000:
        capacity = (low + high) // 2
        packed = pack_counts(sizes, capacity, shards)
        if packed is not None:
            best, high = packed, capacity
        else:
            low = capacity + 1
    return best


def _group(text: Column) -> Column:
    return F.coalesce(text_key(text), F.lit(b""))


def _size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


class Assignment:
    """Shard of every group: a bounded table of large ones, and a table of all others."""

    def __init__(self, groups: DataFrame, shards: int, scratch: Scratch):
        """``groups``: ``key, size`` of any parts of the groups."""
        spark = groups.sparkSession
        whole = scratch.keep(groups.groupBy("key").agg(F.sum("size").alias("size")), "groups")
        sizes = [tuple(r) for r in whole.groupBy("size").count().collect()]  # at most sqrt(2 bytes)
        total = sum(size * count for size, count in sizes)
        runs = pack_into(sizes, shards)
        large = F.col("size") * (FINE * shards) >= total
        # At most FINE * shards rows, numbered within their size like all others.
        heavy = whole.where(large).orderBy(F.desc("size"), "key").collect()
        spans = [(size, shard) for size, _, n, shard in runs if size * FINE * shards >= total for _ in range(n)]
        self.large = spark.createDataFrame(
            [(r.key, shard) for r, (_, shard) in zip(heavy, spans, strict=True)], "large_key binary, large_shard int"
        )
        cell = F.pmod(F.xxhash64("key"), F.lit(RANK_CELLS))
        small = whole.where(~large).withColumn("cell", cell)
        sooner = W.partitionBy("size").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
        cells = small.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n"))
        cells = cells.select("size", "cell", F.coalesce(F.sum("n").over(sooner), F.lit(0)).alias("before"))
        place = F.row_number().over(W.partitionBy("size", "cell").orderBy("key")) - 1
        small = small.withColumn("place", place).join(cells, ["size", "cell"])
        small = small.select("key", "size", (F.col("place") + F.col("before")).alias("nth"))
        light = [run for run in runs if run[0] * FINE * shards < total]
        table = spark.createDataFrame(light, "run_size long, first long, n long, small_shard int")
        here = (F.col("size") == F.col("run_size")) & (F.col("nth") >= F.col("first"))
        here &= F.col("nth") < F.col("first") + F.col("n")
        found = small.join(table, here).select(F.col("key").alias("small_key"), "small_shard")
        self.small = scratch.keep(found, "assigned")

    def assign(self, rows: DataFrame, key: str, shard: str) -> DataFrame:
        """Adds the shard of the group in column ``key``; rows of large groups stay where
        they are, the others meet their group, of which none holds many."""
        names = rows.columns
        large, small = (
            table.select(F.struct("*").alias(n)) for table, n in zip((self.large, self.small), fresh(rows, "large", "small"))
        )
        big, little = large.columns[0], small.columns[0]
        same = F.col(key) == F.col(f"{big}.large_key")
        heavy = rows.join(F.broadcast(large), same).select(*names, F.col(f"{big}.large_shard").alias(shard))
        light = rows.join(F.broadcast(large), same, "left_anti")
        light = light.join(small, F.col(key) == F.col(f"{little}.small_key"))
        return heavy.unionByName(light.select(*names, F.col(f"{little}.small_shard").alias(shard)))


def shard_documents(docs: DataFrame, shards: int, scratch: Scratch) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    Slots have no gaps. Rows are numbered in cells, each some input splits of a shard, on
    top of the counts of the cells before, so neither a shard nor a large group is
    gathered in one task; within a cell they follow the order of the input.
    """
    rows = scratch.keep(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            _size(F.col("text")).alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            _group(F.col("text")).alias("key"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "rows",
    )
    placed = Assignment(rows, shards, scratch).assign(rows, "key", "shard").drop("key")
    # The upper bits of the place are the input split.
    split = F.shiftright("place", 33) % SLOT_CELLS
    placed = scratch.keep(placed.withColumn("cell", split), "placed")
    scratch.drop("rows", "groups", "assigned")
    before = F.sum("n").over(
        W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    )
    cells = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.select("shard", "cell", F.coalesce(before, F.lit(0)).alias("before"))
    nth = F.row_number().over(W.partitionBy("shard", "cell").orderBy("place"))
    slots = placed.withColumn("nth", nth).join(cells, ["shard", "cell"])
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("nth") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded_rows(docs: DataFrame, shards: int, name: str = "shard") -> DataFrame:
    """All rows and columns, and the shard of each in a further column."""
    key, shard = fresh(docs, "group", name)
    groups = docs.select(_group(F.col("text")).alias("key"), _size(F.col("text")).alias("size"))
    found = Assignment(groups, shards, Scratch(docs.sparkSession, "shards"))
    return found.assign(docs.withColumn(key, _group(F.col("text"))), key, shard).drop(key)
