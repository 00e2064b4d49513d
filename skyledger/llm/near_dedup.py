"""Near-duplicate classes: consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of shingles of ``SHINGLE`` words (shorter texts are one
shingle). The weight is ``1 + ln(tf)`` times a smoothed idf. Improved consistent
weighted sampling (Ioffe 2010) draws ``BANDS * ROWS`` samples of which two texts
share a share equal to their weighted Jaccard similarity; texts that agree in all
samples of a band are candidates, and candidates are verified with the weighted
Jaccard similarity itself. Classes are the connected components of the verified
links; equal texts belong to one class from the start.

Candidates of a bucket are not compared all with all. First the ``PIVOTS`` most
connected texts of each bucket are compared with the others, in two rounds; that
joins most of a group of copies at about one comparison each. A bucket that still
holds several classes has a main one. Only the texts outside of it are compared
with all of the bucket, in blocks: a task holds a block of them and streams a part
of the bucket past it, so no row per pair is made and no group is held whole. Pairs
that are not compared are in one class already, so no link that would join two
classes is lost.

Document frequencies come from all documents, counted in ``DF_CELLS`` hash cells
of fixed number; the mean cell is taken off as what chance puts there.

Null texts and texts without words have no shingles: null rows are classes of
their own, other such texts only equal their copies. A class id is the least
doc_id; null ids are not counted. An empty table gives no rows. Other columns are
ignored or, in ``first_of_class``, passed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.llm.common import (
    MULTIPLIER,
    Scratch,
    Shared,
    WordHashes,
    as_bytes,
    counted,
    fresh,
    mixed,
    ngrams,
    row_pass,
    text_key,
)

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
DF_CELLS = 1 << 16
#: The rarest shingle weighs this much more than one that is in every document.
IDF_GAIN = 0.25
#: Rows of random numbers, to which shingles are hashed, and the step to which the
#: logs of weights are rounded; draws are tabulated for both.
DRAWS, LN_STEP, LN_LEVELS = 1 << 12, 0.05, 64
#: Texts of a bucket that have been compared with all others after each round.
PIVOTS = (1, 4)
#: Texts compared with one text in a task's run; texts held, and streamed past them.
CHUNK, HELD, STREAMED = 256, 64, 1024
#: Keys up to which the candidates' texts are fetched with a broadcast.
BROADCAST_KEYS = 500_000


def shingles(text: bytes | None, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ascending, and how often each occurs."""
    words = text.split() if text else []
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(ngrams(hashes.of(words), min(SHINGLE, len(words))), return_counts=True)


def _df_cell(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(48)).astype(np.int64)


class _DocumentFrequency:
    def __init__(self):
        self.total, self.hashes = np.zeros(DF_CELLS, np.int64), WordHashes()

    def __call__(self, batch: pa.RecordBatch) -> None:
        for text in as_bytes(batch):
            np.add.at(self.total, np.unique(_df_cell(shingles(text, self.hashes)[0])), 1)


def inverse_frequency(docs: DataFrame) -> np.ndarray:
    """idf by cell, 1 to 1 + IDF_GAIN."""
    df = counted(docs.select("text"), DF_CELLS, _DocumentFrequency)
    n = max(2, docs.count())
    df = np.clip(df - df.mean(), 1, n)
    return (1 + IDF_GAIN * np.log(n / df) / np.log(n)).astype(np.float32)


class Weights:
    """Weighted shingles of texts. The log of a weight, ``1 + ln(tf)`` times idf, is
    rounded to a multiple of LN_STEP."""

    def __init__(self, idf: np.ndarray):
        self.idf, self.hashes = idf, WordHashes()

    def levels(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        grams, tf = shingles(text, self.hashes)
        ln = np.log((1 + np.log(tf)) * self.idf[_df_cell(grams)])
        return grams, np.minimum(np.rint(ln / LN_STEP).astype(np.int64), LN_LEVELS - 1)

    def of(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        grams, level = self.levels(text)
        return grams, np.exp(level * LN_STEP)


class WeightedSampler(Weights):
    """Improved consistent weighted sampling."""

    def __init__(self, idf: np.ndarray):
        super().__init__(idf)
        random, self.shape = np.random.default_rng(20_10), (DRAWS, BANDS * ROWS)
        draw = lambda: -np.log(random.random(self.shape, np.float32) + np.float32(1e-12))
        self.r = draw() + draw()
        self.ln_c = np.log(draw() + draw())
        self.beta = random.random(self.shape, np.float32)
        # ln a by level, row and sample; a level is filled when it first occurs.
        self.ln_a = np.empty((LN_LEVELS, *self.shape), np.float32)
        self.filled = np.zeros(LN_LEVELS, bool)

    def _t(self, level, row, sample) -> np.ndarray:
        ln_w = np.asarray(level * LN_STEP, np.float32)
        return np.floor(ln_w / self.r[row, sample] + self.beta[row, sample])

    def _fill(self, level: int) -> None:
        every = slice(None)
        t = self._t(level, every, every)
        self.ln_a[level] = self.ln_c - self.r * (t - self.beta + 1)
        self.filled[level] = True

    def bands(self, text: bytes | None) -> np.ndarray:
        """One hash per band; none for a text without words."""
        grams, level = self.levels(text)
        if not len(grams):
            return np.zeros(0, np.int64)
        for new in np.flatnonzero(np.bincount(level)):
            if not self.filled[new]:
                self._fill(new)
        row = (grams & np.uint64(DRAWS - 1)).astype(np.int64)
        cell, table = level * DRAWS + row, self.ln_a.reshape(-1, self.shape[1])
        every = np.arange(self.shape[1])
        best = np.full(self.shape[1], np.inf, np.float32)
        chosen = np.zeros(self.shape[1], np.int64)
        for at in range(0, len(cell), 2048):
            ln_a = np.ascontiguousarray(table[cell[at : at + 2048]].T)
            first = ln_a.argmin(axis=1)  # of equal ones the lowest shingle
            low = ln_a[every, first]
            chosen = np.where(low < best, at + first, chosen)
            best = np.minimum(low, best)
        t = self._t(level[chosen], row[chosen], every).astype(np.int64).view(np.uint64)
        sample = mixed(mixed(grams[chosen] + t * MULTIPLIER) + every.astype(np.uint64))
        sample = sample.reshape(BANDS, ROWS)
        band = sample[:, 0]
        for j in range(1, ROWS):
            band = band * MULTIPLIER + sample[:, j]
        return mixed(band).view(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = b[0][at] == a[0]
    shared = np.minimum(a[1][both], b[1][at[both]]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


def _signatures(docs: DataFrame, idf: Shared) -> DataFrame:
    """``key, bands`` of every row with words."""

    def start():
        sampler = WeightedSampler(idf.load())

        def work(batch: pa.RecordBatch) -> dict:
            bands = [sampler.bands(t) for t in as_bytes(batch)]
            has = [i for i, b in enumerate(bands) if len(b)]
            return {"key": batch.column("key").take(pa.array(has, pa.int64())), "bands": [bands[i] for i in has]}

        return work

    rows = docs.select(text_key(F.col("text")).alias("key"), "text")
    return row_pass(rows, "key binary, bands array<long>", start)


def _members(signatures: DataFrame) -> DataFrame:
    """``bucket, key``: buckets of at least two texts, copies of a text counted once.
    Of buckets with the same texts the one of the first band is enough."""
    rows = signatures.select(F.posexplode("bands").alias("band", "bucket"), "key")
    mark = F.xxhash64("key")
    several = (
        rows.groupBy("bucket")
        .agg(F.min(mark).alias("least"), F.max(mark).alias("most"))
        .where(F.col("least") != F.col("most"))
        .select("bucket")
    )
    members = rows.join(several, "bucket", "left_semi").distinct()
    # Equal sets have equal counts and sums of two hashes.
    other = F.xxhash64("key", F.lit(1))
    sets = members.groupBy("band", "bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.shiftright(mark, 16)).alias("s1"),
        F.sum(F.shiftright(other, 16)).alias("s2"),
    )
    first = sets.groupBy("n", "s1", "s2").agg(F.min(F.struct("band", "bucket")).alias("first"))
    return members.join(first.select("first.bucket"), "bucket", "left_semi").select("bucket", "key")


def _texts(docs: DataFrame, members: DataFrame, signatures: DataFrame) -> DataFrame:
    """``key, text, bands`` of the candidates, each text once."""
    keys = members.select("key").distinct()
    rows = docs.select(text_key(F.col("text")).alias("key"), "text")
    small = keys.count() <= BROADCAST_KEYS
    wanted = rows.join(F.broadcast(keys) if small else keys, "key", "left_semi")
    nth = F.row_number().over(W.partitionBy("key").orderBy("key"))
    wanted = wanted.withColumn("nth", nth).where("nth = 1").drop("nth")
    bands = signatures.join(keys, "key", "left_semi").groupBy("key").agg(F.first("bands").alias("bands"))
    return wanted.join(bands, "key")


def _verified(pairs: DataFrame, texts: DataFrame, idf: Shared) -> DataFrame:
    """The pairs ``a, b`` whose weighted Jaccard similarity is high enough.

    The text of ``a`` is sent once for each chunk of its partners, before them.
    """
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    chunk = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / CHUNK)).cast("int").alias("chunk")
    dealt = pairs.join(counts, "a").select("a", "b", chunk)
    b = dealt.join(texts.select(F.col("key").alias("b"), "text"), "b").select("a", "chunk", "b", "text")
    heads = dealt.select("a", "chunk").distinct()
    a = heads.join(texts.select(F.col("key").alias("a"), "text"), "a").select(
        "a", "chunk", F.lit(None).cast("binary").alias("b"), "text"
    )
    runs = a.unionByName(b).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())

    def start():
        shingled = Weights(idf.load())
        current = [None, None]

        def work(batch: pa.RecordBatch) -> dict:
            found = []
            for a, b, text in zip(
                batch.column("a").to_pylist(), batch.column("b").to_pylist(), as_bytes(batch)
            ):
                weights = shingled.of(text)
                if b is None:
                    current[:] = a, weights
                elif current[0] == a and weighted_jaccard(current[1], weights) >= SIMILARITY:
                    found.append((a, b))
            return {"a": [x for x, _ in found], "b": [y for _, y in found]}

        return work

    return row_pass(runs, "a binary, b binary", start)


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, root`` of every node of the edges ``a, b``: the least node it reaches.

    Each step takes the least root among the neighbours and then the root's root;
    what is left of a path halves, so long chains take few steps.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = scratch.keep(both, f"{name}-edges")
    roots = scratch.keep(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")),
        f"{name}-0",
    )
    step = 0
    while True:
        step += 1
        near = (
            both.join(roots, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("root").alias("near"))
        )
        lower = roots.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("root", "near").alias("next"), "root"
        )
        up = roots.select(F.col("node").alias("up"), F.col("root").alias("above"))
        moved = lower.join(up, F.col("next") == F.col("up"), "left").select(
            "node", F.coalesce(F.least("next", "above"), F.col("next")).alias("root"), F.col("root").alias("was")
        )
        moved = scratch.keep(moved, f"{name}-{step}")
        done = moved.where(F.col("root") != F.col("was")).isEmpty()
        scratch.drop(f"{name}-{step - 1}")
        roots = moved.drop("was")
        if done:
            scratch.drop(f"{name}-edges")
            return roots


class _BlockCompare:
    """Links between held texts and those streamed past them, run by run.

    Rows come by ``bucket, block, chunk``, the held ones first. A pair is compared in
    the first bucket it shares, unless it is in one class; of two texts that are both
    outside the main class, only that with the lesser key is held against the other.
    """

    def __init__(self, idf: np.ndarray):
        self.shingled, self.run = Weights(idf), None

    def _hold(self, key, root, bands, text) -> None:
        self.held.append((key, root, self.shingled.of(text)))
        self.bands = np.vstack([self.bands, bands])

    def _links(self, bucket, key, root, outside, bands, text) -> list:
        same = self.bands == bands
        first = same.argmax(axis=1)
        here = self.bands[np.arange(len(first)), first] == bucket
        near = [
            self.held[i]
            for i in np.flatnonzero(here & same.any(axis=1))
            if self.held[i][1] != root and not (outside and self.held[i][0] >= key)
        ]
        if not near:
            return []
        weights = self.shingled.of(text)
        return [(r, root) for _, r, w in near if weighted_jaccard(w, weights) >= SIMILARITY]

    def __call__(self, batch: pa.RecordBatch) -> dict:
        found = []
        names = ("bucket", "block", "chunk", "streamed", "key", "root", "outside", "bands")
        for bucket, block, chunk, streamed, key, root, outside, bands, text in zip(
            *(batch.column(n).to_pylist() for n in names), as_bytes(batch)
        ):
            if (bucket, block, chunk) != self.run:
                self.run, self.held = (bucket, block, chunk), []
                self.bands = np.zeros((0, BANDS), np.int64)
            bands = np.array(bands, np.int64)
            if streamed:
                found += self._links(bucket, key, root, outside, bands, text)
            else:
                self._hold(key, root, bands, text)
        found = sorted(set(found))
        return {"a": [a for a, _ in found], "b": [b for _, b in found]}


def _rest_links(placed: DataFrame, texts: DataFrame, idf: Shared) -> DataFrame:
    """Links ``a, b`` between classes, from comparing the texts outside the main class
    of each bucket with all texts of the bucket. ``placed``: ``bucket, key, root``."""
    by_class = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    main = by_class.groupBy("bucket").agg(
        F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("all")
    )
    size = main.select(
        "bucket",
        F.col("main.root").alias("main"),
        F.ceil((F.col("all") - F.col("main.n")) / HELD).cast("int").alias("blocks"),
        F.ceil(F.col("all") / STREAMED).cast("int").alias("chunks"),
    )
    rows = placed.join(size, "bucket").withColumn("outside", F.col("root") != F.col("main"))
    deal = F.xxhash64("key")
    columns = ["bucket", "block", "chunk", "streamed", "key", "root", "outside"]
    held = rows.where("outside").select(
        "*",
        F.pmod(deal, F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.lit(False).alias("streamed"),
    )
    streamed = rows.select(
        "*",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(deal, F.col("chunks")).cast("int").alias("chunk"),
        F.lit(True).alias("streamed"),
    )
    runs = held.select(*columns).unionByName(streamed.select(*columns)).join(texts, "key")
    runs = runs.repartition("bucket", "block", "chunk").sortWithinPartitions(
        "bucket", "block", "chunk", "streamed"
    )
    return row_pass(runs, "a binary, b binary", lambda: _BlockCompare(idf.load()))


def _merged(classes: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The classes ``key, root`` after links between roots."""
    if links.isEmpty():
        return classes
    roots = components(links.distinct(), scratch, f"roots-{name}")
    renamed = roots.select(F.col("root").alias("new"), F.col("node").alias("root"))
    root = F.coalesce(F.col("new"), F.col("root")).alias("root")
    return scratch.keep(classes.join(renamed, "root", "left").select("key", root), f"classes-{name}")


def _linked(members: DataFrame, texts: DataFrame, idf: Shared, scratch: Scratch) -> DataFrame:
    """``key, root`` of all candidates, by verified links."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    ties = members.join(sizes, "bucket").groupBy("key").agg(F.sum("n").alias("score"))
    ranked = scratch.keep(members.join(ties, "key"), "ranked")
    classes = ranked.select("key", F.col("key").alias("root")).distinct()
    classes = scratch.keep(classes, "classes-0")
    compared = 0
    for ahead in (*PIVOTS, None):
        placed = ranked.join(classes, "key")
        mark = F.xxhash64("root")
        open_ = (
            placed.groupBy("bucket")
            .agg(F.min(mark).alias("least"), F.max(mark).alias("most"), F.count(F.lit(1)).alias("n"))
            .where((F.col("least") != F.col("most")) & (F.col("n") > compared + 1))
            .select("bucket")
        )
        placed = scratch.keep(placed.join(open_, "bucket", "left_semi"), f"open-{ahead}")
        if placed.isEmpty():
            return classes
        if ahead is None:
            links = _rest_links(placed.drop("score"), texts, idf)
            links = scratch.keep(links, "links-rest")
            return _merged(classes, links, scratch, "rest")
        order = W.partitionBy("bucket").orderBy(F.col("score").desc(), F.col("key").desc())
        chosen = (
            placed.withColumn("nth", F.row_number().over(order))
            .where(F.col("nth") <= ahead)
            .where(F.col("nth") > compared)
            .select("bucket", F.col("key").alias("a"), F.col("root").alias("a_root"), F.col("score").alias("a_score"))
        )
        later = F.struct("score", "key") < F.struct(F.col("a_score"), F.col("a"))
        pairs = (
            placed.join(chosen, "bucket")
            .where((F.col("root") != F.col("a_root")) & later)
            .select("a", F.col("key").alias("b"), "a_root", "root")
            .distinct()
        )
        pairs = scratch.keep(pairs, f"pairs-{ahead}")
        links = scratch.keep(_verified(pairs.select("a", "b"), texts, idf), f"links-{ahead}")
        joined = links.join(pairs, ["a", "b"]).select(F.col("a_root").alias("a"), F.col("root").alias("b"))
        classes = _merged(classes, joined, scratch, str(ahead))
        scratch.drop(f"pairs-{ahead}", f"links-{ahead}", f"open-{ahead}")
        compared = ahead
    return classes


def text_classes(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``key, class_id, class_size, first`` of every text; ``first`` marks the text
    that stands for its class, the one with the least id."""
    idf = Shared(docs.sparkSession, inverse_frequency(docs))
    signatures = scratch.keep(_signatures(docs, idf), "signatures")
    members = scratch.keep(_members(signatures), "members")
    texts = scratch.keep(_texts(docs, members, signatures), "texts")
    scratch.drop("signatures")
    linked = _linked(members, texts, idf, scratch)
    scratch.drop("texts", "members", "ranked")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"))
    own = (
        rows.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    )
    own = scratch.keep(own.join(linked, "key", "left").withColumn("root", F.coalesce("root", "key")), "own")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    whole = own.groupBy("root").agg(best.alias("best"), F.sum("n").alias("class_size"))
    return own.join(whole, "root").select(
        "key", F.col("best.id").alias("class_id"), "class_size", (F.col("key") == F.col("best.key")).alias("first")
    )


def near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, class_id, class_size`` of every row."""
    classes = text_classes(docs, scratch)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"))
    return rows.join(classes, "key", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )


def first_of_class(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row of each class, all columns: the first text, and of its rows that with
    the least id. Rows without a text all stay."""
    key, nth = fresh(docs, "text_key", "nth")
    keyed = docs.withColumn(key, text_key(F.col("text")))
    # Each task first drops all but one of its rows with the same text.
    order = W.partitionBy(key).orderBy(F.col("doc_id").asc_nulls_last())
    once = keyed.where(F.col(key).isNotNull()).withColumn(nth, F.row_number().over(order))
    once = once.where(F.col(nth) == 1).drop(nth)
    firsts = text_classes(docs, scratch).where("first").select(F.col("key").alias(key))
    kept = once.join(firsts, key, "left_semi")
    return kept.drop(key).unionByName(docs.where(F.col("text").isNull()))
