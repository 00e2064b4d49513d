"""Prefix trie of conversations, with what sharing its nodes would save.

Every distinct sequence of first turns is a node. Conversations are put into the
order of a depth-first walk and cut into shards of consecutive ones. Each shard
writes its part of the trie as balanced parentheses: blocks of their running excess,
with a tree of minima above them, find where a subtree closes, the rank of ``()``
pairs counts its leaves, and a cumulative array over the opening parentheses sums its
savings. Nodes on the way to a shard's first conversation are open in earlier shards
too; the parts of such shared spines are added up.

Only nodes where paths part or end are written as parentheses. A run of nodes between
them has the same members, so its values follow from the node below by one
subtraction, and a conversation of any length is a few parentheses.

Texts are replaced by digests of role and text before anything is shuffled. A node is
known by two sums of 64-bit hashes over the places and digests of its turns, so sums
over ``CHUNK`` turns at a time make the nodes of a very long conversation.

Rows without ``conv_id`` belong to no conversation and are left out. Null turns come
first, equal turns are ordered by the digest of role and text, and repeated rows are
turns of their own. Null roles and texts are empty. Very long texts count by their
UTF-8 bytes. An empty table has no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.llm.common import Scratch

#: A family is the ids with the same multiple of this below them.
FAMILY = 5
#: Turns that a conversation may take from the first of its family: 0 to MOST_SHARED - 1.
MOST_SHARED = 9
#: Turns of one conversation that are summed in one group.
CHUNK = 4096
#: Parts into which the rows that meet one node in a join are dealt.
SALTS = 8
#: Positions of a block of the excess, and ids written at once into a digest.
BLOCK, IDS = 256, 4096
DIGIT = 32


def _node(depth: Column, one: Column, two: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth, one, two).cast("binary")))


def _sorted(df: DataFrame, scratch: Scratch, name: str, *order: Column) -> DataFrame:
    """The rows in order over all partitions, stored with ``part`` and ``seq``."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch.keep(
        ranged.select(
            F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"), "*"
        ),
        name,
    )


def _many_to_one(many: DataFrame, one: DataFrame, key: str, by: str, how: str) -> DataFrame:
    """Join with a table of unique keys; the rows of a frequent key go to ``SALTS`` tasks."""
    copies = one.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    dealt = many.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return dealt.join(copies, [key, "salt"], how).drop("salt")


def rebuilt(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv_id, size``) and their turns (``conv_id, depth, size, token,
    bytes``): the shared first turns of the family's first member, then the own ones."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.md5(role.cast("binary")), F.md5(text.cast("binary"))).cast("binary"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        digest.alias("token"),
        F.octet_length(text).cast("long").alias("bytes"),
        # Tells repeated rows apart for the cut into ranges only.
        F.monotonically_increasing_id().alias("place"),
    )
    order = F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("token"), F.col("place")
    turns = _sorted(turns, scratch, "sorted", *order)

    parts = turns.groupBy("part", "conv_id").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    whole = W.partitionBy("conv_id")
    parts = parts.withColumn("total", F.sum("n").over(whole)).withColumn(
        "before", F.sum("n").over(whole.orderBy("part")) - F.col("n")
    )
    id_ = F.col("conv_id")
    convs = parts.groupBy("conv_id").agg(F.max("total").alias("n")).select(
        "conv_id",
        "n",
        (id_ - id_ % FAMILY).alias("base"),
        (F.crc32(id_.cast("string").cast("binary")) % MOST_SHARED).alias("h"),
    )
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = scratch.keep(
        convs.join(bases, "base", "left")
        .withColumn("taken", taken)
        .withColumn("size", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))),
        "convs",
    )
    own = parts.join(convs.select("conv_id", "h", "taken", "size"), "conv_id")
    placed = scratch.keep(
        turns.join(own, ["part", "conv_id"]).select(
            "conv_id", "h", "taken", "size", "token", "bytes",
            (F.col("before") + F.col("seq") - F.col("first")).alias("pos"),
        ),
        "placed",
    )
    heads = placed.where((F.col("pos") < MOST_SHARED - 1) & (F.col("conv_id") % FAMILY == 0)).select(
        F.col("conv_id").alias("base"), "pos", "token", "bytes"
    )
    columns = ["conv_id", "depth", "size", "token", "bytes"]
    shared = heads.join(convs, "base").where(F.col("pos") < F.col("h"))
    shared = shared.withColumn("depth", F.col("pos") + 1).select(*columns)
    rest = placed.where(F.col("pos") >= F.col("h"))
    rest = rest.withColumn("depth", F.col("pos") + 1 - F.col("h") + F.col("taken")).select(*columns)
    return convs.select("conv_id", "size"), shared.unionByName(rest)


def _with_nodes(turns: DataFrame) -> DataFrame:
    """Adds ``node``, ``parent`` and ``cum``, the bytes down to and with this turn."""
    hashes = [F.xxhash64("depth", "token"), F.xxhash64("token", "depth", F.lit(1))]
    rows = turns.select(
        "*",
        F.floor((F.col("depth") - 1) / CHUNK).alias("chunk"),
        *(h.cast("decimal(20,0)").alias(f"own{i}") for i, h in enumerate(hashes)),
    )
    summed = {"one": "own0", "two": "own1", "cum": "bytes"}
    totals = rows.where(F.col("size") > CHUNK).groupBy("conv_id", "chunk")
    totals = totals.agg(*(F.sum(c).alias(f"all_{name}") for name, c in summed.items()))
    sooner = W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        "conv_id", "chunk", *(F.sum(f"all_{n}").over(sooner).alias(f"from_{n}") for n in summed)
    )
    here = W.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.select("*", *(F.sum(c).over(here).alias(n) for n, c in summed.items()))
    rows = rows.join(starts, ["conv_id", "chunk"], "left")
    one, two, cum = (F.col(n) + F.coalesce(F.col(f"from_{n}"), F.lit(0)) for n in summed)
    return rows.select(
        "conv_id", "depth", "size", "token", "bytes",
        _node(F.col("depth"), one.cast("string"), two.cast("string")).alias("node"),
        _node(
            F.col("depth") - 1,
            (one - F.col("own0")).cast("string"),
            (two - F.col("own1")).cast("string"),
        ).alias("parent"),
        cum.cast("long").alias("cum"),
    )


def _root() -> Column:
    return _node(F.lit(0), F.lit("0"), F.lit("0"))


def _nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node with what its own members tell of it."""
    nodes = turns.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent"),
        F.count("*").alias("n_convs"),
        F.count_if(F.col("depth") == F.col("size")).alias("ends"),
        F.min("bytes").alias("bytes"),
        F.min("cum").alias("cum"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.count_if(F.col("size") == 0).alias("ends"),
    ).where("n_convs > 0")
    root = root.select(
        _root().alias("node"), "conv_id", zero.alias("depth"), F.lit(None).cast("binary").alias("parent"),
        "n_convs", "ends", zero.alias("bytes"), zero.alias("cum"),
    )
    nodes = nodes.unionByName(root)
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node"))
    children = children.agg(F.count("*").alias("n_children"))
    return nodes.join(children, "node", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
    )


class Parentheses:
    """A forest as balanced parentheses, with the excess in blocks and a tree of their minima."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        n = len(opens)
        blocks = max(1, -(-n // BLOCK))
        self.leaves = 1 << (blocks - 1).bit_length()
        padded = np.full(self.leaves * BLOCK, n + 1, np.int64)
        padded[:n] = self.excess
        self.least = np.empty(2 * self.leaves, np.int64)
        self.least[self.leaves :] = padded.reshape(-1, BLOCK).min(axis=1)
        for i in range(self.leaves - 1, 0, -1):
            self.least[i] = min(self.least[2 * i], self.least[2 * i + 1])

    def findclose(self, p: int) -> int:
        """Position of the parenthesis that closes the one opened at ``p``."""
        goal = self.excess[p] - 1
        block = p // BLOCK
        near = np.flatnonzero(self.excess[p : (block + 1) * BLOCK] <= goal)
        if len(near):
            return p + int(near[0])
        i = self.leaves + block
        while True:  # up until a block to the right holds it, then down to the first such
            while i & 1:
                i >>= 1
            i += 1
            if self.least[i] <= goal:
                break
        while i < self.leaves:
            i = 2 * i if self.least[2 * i] <= goal else 2 * i + 1
        start = (i - self.leaves) * BLOCK
        return start + int(np.flatnonzero(self.excess[start : start + BLOCK] <= goal)[0])


class _Shard:
    """Parentheses of the classes of a shard, which come in depth-first order."""

    def __init__(self, total: int):
        self.total, self.bits, self.rows, self.key, self.levels = total, [], [], None, 0
        self.not_leaf = -1

    def add(self, key, before, depths, counts, tops, parents, node, depth, cum, leaf) -> None:
        """``key``: digests of the turns after each parting of ways; ``depths, counts,
        tops, parents``: depth and members of that turn's node, bytes above it, the node
        above it. ``before``: key of the last class of the shard before, if any."""
        spine = self.key is None and before is not None
        last = before if spine else self.key
        common = -1
        if last is not None:
            common, most = 0, min(len(last), len(key)) // DIGIT
            while common < most and (
                last[common * DIGIT : (common + 1) * DIGIT] == key[common * DIGIT : (common + 1) * DIGIT]
            ):
                common += 1
        self.bits += [False] * (self.levels - common - 1) if not spine else []
        m = len(depths)
        for j in range(0 if spine else common + 1, m + 1):
            bottom, at, n = (tops[j], depths[j] - 1, parents[j]) if j < m else (cum, depth, node)
            top = tops[j - 1] if j else 0
            members = counts[j - 1] if j else self.total
            # The node of the shard before has its own savings there.
            weight = 0 if spine and j <= common else (members - 1) * (bottom - top)
            self.rows.append((n, weight, depths[j - 1] if j else 0, top))
            self.bits.append(True)
        self.not_leaf = -1 if leaf else len(self.bits) - 1
        self.key, self.levels = key, m + 1

    def sums(self) -> dict:
        opens = np.array(self.bits + [False] * self.levels, bool)
        forest = Parentheses(opens)
        pairs = opens[:-1] & ~opens[1:]
        if self.not_leaf >= 0:  # what goes on below it is in the next shard
            pairs[self.not_leaf] = False
        rank = np.concatenate([[0], np.cumsum(pairs)])
        saved = np.concatenate([[0], np.cumsum([r[1] for r in self.rows])])
        leaves, sums = [], []
        for k, p in enumerate(np.flatnonzero(opens).tolist()):
            q = forest.findclose(p)
            leaves.append(int(rank[q] - rank[p]))
            sums.append(int(saved[k + (q - p + 1) // 2] - saved[k]))
        return {
            "node": [r[0] for r in self.rows],
            "leaves": leaves,
            "saved": sums,
            "low": [r[2] for r in self.rows],
            "top": [r[3] for r in self.rows],
        }


def _subtrees(classes: DataFrame, total: int) -> DataFrame:
    """``node, leaves, saved, low, top`` of nodes where paths part or end; ``saved`` has
    the whole run of nodes above it, which starts at depth ``low`` below ``top`` bytes."""
    names = ["key", "before", "depths", "counts", "tops", "parents", "node", "depth", "cum", "leaf"]
    schema = "node binary, leaves long, saved long, low long, top long"
    kinds = {"node": pa.binary(), **dict.fromkeys(("leaves", "saved", "low", "top"), pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last = _Shard(total), None

        def out(columns: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[n], kind) for n, kind in kinds.items()], names=list(kinds)
            )

        for batch in batches:
            for part, *row in zip(*(batch.column(n).to_pylist() for n in ["part", *names])):
                if part != last and shard.rows:
                    yield out(shard.sums())
                    shard = _Shard(total)
                last = part
                shard.add(*row)
        if shard.rows:
            yield out(shard.sums())

    parts = classes.select("part", *names).mapInArrow(run, schema)
    return parts.groupBy("node").agg(
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
        F.min("low").alias("low"),
        F.min("top").alias("top"),
    )


def _digests(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256``: the ids that end at a node, in order. Ids become runs of at
    most ``IDS`` in sorted ranges; a digest reads the runs of its node one by one."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
            cuts = [0, *(i for i in range(1, len(ids)) if nodes[i] != nodes[i - 1]), len(ids)]
            spans = [(a, min(a + IDS, end)) for at, end in zip(cuts, cuts[1:]) for a in range(at, end, IDS)]
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array([nodes[a] for a, _ in spans], pa.binary()),
                    "first": pa.array([ids[a] for a, _ in spans], pa.int64()),
                    "ids": pa.array([",".join(map(str, ids[a:b])) for a, b in spans], pa.string()),
                }
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None

        def out(done):
            nodes, hashes = [d[0] for d in done], [d[1].hexdigest() for d in done]
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())], names=["node", "ends_sha256"]
            )

        for batch in batches:
            done = []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if node == last:
                    sha.update(b"," + ids.encode())
                else:
                    if sha:
                        done.append((last, sha))
                    last, sha = node, hashlib.sha256(ids.encode())
            yield out(done)
        if sha:
            yield out([(last, sha)])

    ordered = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ordered.select("node", "conv_id").mapInArrow(runs, "node binary, first long, ids string")
    together = pieces.repartition("node").sortWithinPartitions("node", "first")
    return together.select("node", "ids").mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` (what a saved token is: a byte of a turn that a second
    member repeats)."""
    convs, turns = rebuilt(conversations, scratch)
    turns = scratch.keep(_with_nodes(turns), "turns")
    scratch.drop("sorted", "placed")
    nodes = scratch.keep(_nodes(convs, turns), "nodes")
    parting = (F.col("n_children") != 1) | (F.col("ends") > 0)

    above = nodes.where(F.col("n_children") > 0).select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), parting.alias("parts")
    )
    nodes = scratch.keep(_many_to_one(nodes, above, "parent", "node", "left"), "linked")

    ends = turns.where(F.col("depth") == F.col("size")).select("conv_id", "node")
    ends = ends.unionByName(convs.where(F.col("size") == 0).select("conv_id", _root().alias("node")))
    classes = ends.groupBy("node").agg(F.min("conv_id").alias("conv_id"))
    classes = classes.join(
        nodes.select("node", "depth", "cum", (F.col("n_children") == 0).alias("leaf")), "node"
    )
    entries = nodes.where("parts").select(
        "node", "parent", F.col("n_convs").alias("count"), (F.col("cum") - F.col("bytes")).alias("top")
    )
    steps = _many_to_one(
        turns.select("conv_id", "depth", "token", "node"), entries, "node", "conv_id", "inner"
    )
    step = F.struct("depth", "token", "count", "top", "parent")
    paths = steps.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("path"))

    def column(name: str) -> Column:
        return F.coalesce(F.col(f"path.{name}"), F.array())

    classes = classes.join(paths, "conv_id", "left").select(
        F.array_join(column("token"), "").alias("key"),
        column("depth").alias("depths"), column("count").alias("counts"),
        column("top").alias("tops"), column("parent").alias("parents"),
        "node", "depth", "cum", "leaf",
    )
    classes = _sorted(classes, scratch, "classes", F.col("key"))
    edges = classes.groupBy("part").agg(F.min("seq").alias("seq"), F.max_by("key", "seq").alias("last"))
    edges = edges.select("seq", F.lag("last").over(W.orderBy("part")).alias("before"))
    classes = classes.join(edges, "seq", "left").repartition("part").sortWithinPartitions("part", "seq")

    # A node without a parting of its own has the values of the next one below it, for
    # which each chunk of depths that this lies beyond gets a mark of its own.
    known = nodes.select("node", "conv_id", "depth", "n_convs", "n_children", "parent_conv_id", "bytes", "cum")
    known = known.join(_subtrees(classes, convs.count()), "node", "left").withColumn(
        "below", F.when(F.col("leaves").isNotNull(), F.struct("leaves", "saved", "top"))
    )
    known = scratch.keep(
        known.withColumn("chunk", F.floor(F.col("depth") / CHUNK)).withColumn("mark", F.lit(False)), "known"
    )
    first = F.floor(F.col("low") / CHUNK)
    long_runs = known.where(F.col("leaves").isNotNull() & (first < F.col("chunk")))
    marks = long_runs.withColumn("chunk", F.explode(F.sequence(first, F.col("chunk") - 1)))
    marks = marks.withColumn("depth", (F.col("chunk") + 1) * CHUNK).withColumn("mark", F.lit(True))
    upwards = W.partitionBy("conv_id", "chunk").orderBy(F.col("depth").desc())
    upwards = upwards.rowsBetween(W.unboundedPreceding, 0)
    rows = known.unionByName(marks).withColumn("below", F.last("below", ignorenulls=True).over(upwards))
    above = (F.col("n_convs") - 1) * (F.col("cum") - F.col("bytes") - F.col("below.top"))
    return (
        rows.where(~F.col("mark"))
        .join(_digests(ends), "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            F.col("below.leaves").alias("n_leaves"),
            (F.col("below.saved") - above).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
