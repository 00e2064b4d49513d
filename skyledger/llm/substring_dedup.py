"""Substring dedup with sharded FM-indexes.

Every window of ``WINDOW`` words whose word sequence also starts somewhere else is
repeated; words covered by a repeated window are removed. Windows are judged on
the input, so all copies go, the first included.

Dealing to shards. A window's anchor is its ``GRAM``-word gram with the least
hash, the leftmost of equal ones. Equal windows have equal anchors, so a shard
that holds all windows of an anchor can judge them. Consecutive windows with the
same anchor place form a segment, and each window lies in one segment. Anchors
that occur once cannot belong to repeated windows; their segments are not sent.

Index. A shard holds each distinct segment once, with the number of its
occurrences, as word numbers in an FM-index: the Burrows-Wheeler transform in a
wavelet matrix of packed bits. Backward search streams every segment against it
and extends matches to the left while they occur at least twice; matches of at
least ``WINDOW`` words are reported as intervals.

Bounds. A shard task builds one index after another, each of about ``INDEX_WORDS``
words. An anchor with more than ``HOT_SEGMENTS`` distinct segments (a passage in
very many contexts) has them cut into single windows, dealt by their content, so
no group of distinct texts is unbounded; equal texts, segments and windows are
collapsed before they are sent. Where rows meet what was found for their anchor,
segment or window, those of frequent ones are not shuffled: at most ``HEAVY_KEYS``
such keys are broadcast.

Null texts have no words; texts shorter than a window keep all. Repeated rows are
occurrences of their own, and each gets the result of its text. An empty table
gives no rows. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.llm.common import Scratch, WordHashes, as_bytes, covered, ngrams, row_pass, text_key

WINDOW = 35
#: Words of an anchor.
GRAM = 8
#: Words of an index, and distinct segments of an anchor that stay whole.
INDEX_WORDS, HOT_SEGMENTS = 250_000, 4096
#: A key with more than HEAVY_ROWS rows and more than 1/HEAVY_KEYS of all is joined apart.
HEAVY_ROWS, HEAVY_KEYS = 100_000, 1000


def anchor_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each window's anchor, and the hashes of all grams."""
    grams = ngrams(hashes, GRAM)
    if len(hashes) < WINDOW:
        return np.zeros(0, np.int64), grams
    least, place, span, width = grams, np.arange(len(grams)), 1, WINDOW - GRAM + 1
    while span < width:
        step = min(span, width - span)
        a, b = least[:-step], least[step:]
        later = b < a
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, b, a)
        span += step
    return place, grams


def segments(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first word and end of each segment of a text."""
    place, grams = anchor_places(hashes)
    if not len(place):
        return np.zeros(0, np.int64), place, place
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    return grams[place[first]].view(np.int64), first, last + WINDOW


#: Bits below a place in its block; what makes a block's bits 1 where the digit matches.
_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)
_FLIP_HIGH = np.array([-1, -1, 0, 0], np.int64).view(np.uint64)
_FLIP_LOW = np.array([-1, 0, -1, 0], np.int64).view(np.uint64)


def _packed(bit: np.ndarray) -> np.ndarray:
    packed = np.packbits(bit.astype(np.uint8), bitorder="little")
    return np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)


class WaveletMatrix:
    """Counts of a symbol before a place. Symbols are cut into two-bit digits; each
    level keeps its digits as two rows of packed bits and counts per block of 64."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = []
        for shift in range((max(1, int(largest).bit_length()) + 1) // 2 * 2 - 2, -1, -2):
            digit = (symbols >> shift) & 3
            high, low = _packed(digit >> 1), _packed(digit & 1)
            order = np.argsort(digit.astype(np.uint8), kind="stable")
            starts = np.searchsorted(digit[order], np.arange(4))
            counts = np.zeros((len(high), 4), np.int64)
            for d in range(4):
                matches = (high ^ _FLIP_HIGH[d]) & (low ^ _FLIP_LOW[d])
                n = np.bitwise_count(matches).astype(np.int64)
                counts[:, d] = np.cumsum(n) - n + starts[d]
            self.levels.append((shift, high, low, counts.ravel()))
            symbols = symbols[order]

    def descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where a place of the text ends up in the symbol's block of the last level."""
        for shift, high, low, counts in self.levels:
            digit = (symbol >> shift) & 3
            block = place >> 6
            matches = (high[block] ^ _FLIP_HIGH[digit]) & (low[block] ^ _FLIP_LOW[digit])
            matches &= _BELOW[place & 63]
            place = counts[block * 4 + digit] + np.bitwise_count(matches)
        return place


class FMIndex:
    """Texts of word numbers (from 1), each with how often it occurs."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, weights: np.ndarray):
        self.words, self.starts, self.lengths = words, starts, lengths
        n, depth = len(words), int(lengths.max()) + 1
        rank, order, k = words.astype(np.int64), None, 1
        while True:  # sorts suffixes by their first k words, doubling k
            order = np.argsort(rank, kind="stable")
            fresh = np.concatenate([[0], np.cumsum(np.diff(rank[order]) != 0)])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            if k >= depth or fresh[-1] == n - 1:
                break
            rank = rank * (n + 1)
            rank[: n - k] += (rank[k:] // (n + 1)) + 1
            k *= 2
        counts = np.bincount(words)
        self.first = np.cumsum(counts) - counts
        self.bwt = WaveletMatrix(words[order - 1].astype(np.int64), len(counts))
        symbols = np.arange(len(counts))
        self.origin = self.bwt.descend(symbols, np.zeros(len(counts), np.int64))
        several = np.zeros(n + 1, bool)  # suffixes of texts that occur more than once
        several[:n] = np.repeat(weights > 1, lengths + 1)[order]
        self.several = several

    def extend(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range of the word before the strings with the given ranges."""
        m = len(word)
        at = self.bwt.descend(np.concatenate([word, word]), np.concatenate([low, high]))
        at += np.tile(self.first[word] - self.origin[word], 2)
        return at[:m], at[m:]

    def repeated_intervals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, start and end of the intervals of at least WINDOW words that occur
        more than once; every repeated window lies in one of them.

        All texts are searched in step, each from its end. Where a match from end
        ``e`` stops at ``i``, no repeated window holds both ``i - 1`` and ``e - 1``,
        and the search goes on from the next end that leaves one out. All windows
        of a text share its middle, so a text whose middle is unique is done.
        """
        n = len(self.words)
        text = np.flatnonzero(self.lengths >= WINDOW)
        end = self.lengths[text].copy()
        left, low, high = end.copy(), np.zeros(len(text), np.int64), np.full(len(text), n)
        resume = np.zeros(len(text), np.int64)  # end to go on from after the middle
        tried = np.zeros(len(text), bool)
        found = [(_NONE, _NONE, _NONE)]
        while len(text):
            word = self.words[self.starts[text] + np.maximum(left - 1, 0)]
            new_low, new_high = self.extend(word, low, high)
            many = (new_high - new_low > 1) | (
                (new_high - new_low == 1) & self.several[np.minimum(new_low, n)]
            )
            go = many & (left > 0)
            left = np.where(go, left - 1, left)
            low, high = np.where(go, new_low, low), np.where(go, new_high, high)
            stop = ~go | (left == 0)
            if not stop.any():
                continue
            long = stop & (end - left >= WINDOW)
            found.append((text[long], left[long], end[long]))
            probing = resume > 0
            after = np.minimum(end - 1, left + WINDOW - 1)
            after = np.where(left == 0, 0, after)
            # The middle of the windows that are left: [after - WINDOW, WINDOW).
            probe = stop & ~probing & ~tried & ~long & (after >= WINDOW) & (after < 2 * WINDOW)
            done_probe = stop & probing
            unique = done_probe & (left > resume - WINDOW)
            after = np.where(done_probe, np.where(unique, 0, resume), after)
            resume = np.where(probe, after, np.where(done_probe, 0, resume))
            after = np.where(probe, WINDOW, after)
            tried |= probe
            end = np.where(stop, after, end)
            left = np.where(stop, end, left)
            low, high = np.where(stop, 0, low), np.where(stop, n, high)
            keep = end >= WINDOW
            if not keep.all():
                text, end, left, low, high, resume, tried = (
                    x[keep] for x in (text, end, left, low, high, resume, tried)
                )
        return tuple(np.concatenate(x) for x in zip(*found))


_NONE = np.zeros(0, np.int64)


def repeated_in(texts: list[bytes], weights: list[int]) -> list[np.ndarray]:
    """Starts and ends (two columns) of the repeated intervals of each text."""
    numbers: dict[bytes, int] = {}
    rows = [[numbers.setdefault(w, len(numbers) + 1) for w in t.split(b" ")] for t in texts]
    lengths = np.array([len(r) for r in rows], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    words = np.zeros(int(lengths.sum()) + len(rows), np.int64)  # a 0 ends each text
    for at, row in zip(starts, rows):
        words[at : at + len(row)] = row
    index = FMIndex(words, starts, lengths, np.array(weights))
    text, low, high = index.repeated_intervals()
    order = np.lexsort((low, text))
    cuts = np.searchsorted(text[order], np.arange(len(texts) + 1))
    spans = np.column_stack([low, high])[order]
    return [spans[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _scan(docs: DataFrame) -> DataFrame:
    """``doc_id, key, n_words, sha256`` of all words, and the anchors, of every row."""

    def start():
        hashes = WordHashes()

        def work(batch: pa.RecordBatch) -> dict:
            words = [t.split() if t else [] for t in as_bytes(batch)]
            return {
                "n_words": [len(w) for w in words],
                "sha256": [hashlib.sha256(b" ".join(w)).hexdigest() for w in words],
                "anchors": [segments(hashes.of(w))[0] for w in words],
            }

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), "text"
    )
    return row_pass(
        rows, "doc_id long, key binary, n_words long, sha256 string, anchors array<long>", start
    )


def _heavy(counts: DataFrame, key: str) -> DataFrame:
    """The keys with more than 1/HEAVY_KEYS of all rows, so fewer than HEAVY_KEYS, of
    ``counts`` (``rows`` for each key)."""
    total = counts.agg(F.sum("rows")).first()[0] or 0
    return counts.where(F.col("rows") > max(HEAVY_ROWS, total // HEAVY_KEYS)).select(key)


def _split_join(left: DataFrame, right: DataFrame, key: str, heavy: DataFrame, how: str = "inner") -> DataFrame:
    """The join with a ``right`` that has a row per key; rows of the heavy keys stay
    where they are and meet a broadcast of at most HEAVY_KEYS rows."""
    if heavy.isEmpty():
        return left.join(right, key, how)
    light = left.join(F.broadcast(heavy), key, "left_anti").join(right, key, how)
    few = right.join(F.broadcast(heavy), key, "left_semi")
    return light.unionByName(left.join(F.broadcast(few), key, how))


def _common_anchors(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, anchors``: for each text those of its anchors that occur again."""
    rows = texts.select("id", "n", F.explode("anchors").alias("anchor"))
    counts = rows.groupBy("anchor").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    counts = scratch.keep(counts.where("n > 1").select("anchor", "rows"), "anchors")
    heavy, rows = _heavy(counts, "anchor"), rows.select("id", "anchor")
    again = _split_join(rows, counts.select("anchor"), "anchor", heavy, "left_semi")
    return again.groupBy("id").agg(F.collect_set("anchor").alias("anchors"))


def _cut_segments(wanted: DataFrame) -> DataFrame:
    """``id, n, start, part, seg, words`` of the segments with the anchors wanted."""

    def start():
        hashes = WordHashes()

        def work(batch: pa.RecordBatch) -> dict:
            out = {c: [] for c in ("id", "n", "start", "part", "seg", "words")}
            for row, n, anchors, text in zip(
                *(batch.column(c).to_pylist() for c in ("id", "n", "anchors")), as_bytes(batch)
            ):
                words = text.split()
                part, first, end = segments(hashes.of(words))
                chosen = np.flatnonzero(np.isin(part, np.array(anchors, np.int64)))
                for k in chosen:
                    own = b" ".join(words[first[k] : end[k]])
                    out["words"].append(own)
                    out["seg"].append(hashlib.md5(own, usedforsecurity=False).digest())
                out["id"] += [row] * len(chosen)
                out["n"] += [n] * len(chosen)
                out["start"] += first[chosen].tolist()
                out["part"] += part[chosen].tolist()
            return out

        return work

    return row_pass(wanted, "id long, n long, start int, part long, seg binary, words binary", start)


def _single_windows(hot: DataFrame) -> DataFrame:
    """``owner, start, seg, words, n``: the windows of segments."""

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            out = {c: [] for c in ("owner", "start", "seg", "words", "n")}
            for owner, text, n in zip(*(batch.column(c).to_pylist() for c in ("seg", "words", "n"))):
                words = text.split(b" ")
                for at in range(len(words) - WINDOW + 1):
                    own = b" ".join(words[at : at + WINDOW])
                    for c, v in zip(out, (owner, at, hashlib.md5(own, usedforsecurity=False).digest(), own, n)):
                        out[c].append(v)
            return out

        return work

    return row_pass(hot, "owner binary, start int, seg binary, words binary, n long", start)


def _judged(units: DataFrame) -> DataFrame:
    """``seg, spans`` of the units (``part, seg, words, n``) with repeated intervals;
    spans are starts and ends in turn. Rows come sorted by part; an index is built
    whenever enough words have come and the part changes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segs, texts, weights, size, last = [], [], [], 0, None

        def flush() -> pa.RecordBatch:
            spans = repeated_in(texts, weights)
            has = [i for i, s in enumerate(spans) if len(s)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([segs[i] for i in has], pa.binary()),
                    pa.array([spans[i].ravel() for i in has], pa.list_(pa.int32())),
                ],
                ["seg", "spans"],
            )

        for batch in batches:
            for part, seg, words, n in zip(
                *(batch.column(c).to_pylist() for c in ("part", "seg", "words", "n"))
            ):
                if size >= INDEX_WORDS and part != last:
                    yield flush()
                    segs, texts, weights, size = [], [], [], 0
                segs.append(seg)
                texts.append(words)
                weights.append(n)
                size += words.count(b" ") + 2
                last = part
        if segs:
            yield flush()

    dealt = units.repartition("part").sortWithinPartitions("part")
    return dealt.select("part", "seg", "words", "n").mapInArrow(run, "seg binary, spans array<int>")


def _repeated_segments(cut: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``seg, spans`` of all distinct segments with repeated intervals, and the ``seg``
    of heavy ones."""
    distinct = cut.groupBy("part", "seg", "words").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    distinct = scratch.keep(distinct, "distinct")
    heavy = scratch.keep(_heavy(distinct, "seg"), "heavy")
    scratch.free()
    hot = (
        distinct.groupBy("part").agg(F.count(F.lit(1)).alias("segments")).where(F.col("segments") > HOT_SEGMENTS)
    ).select("part")
    hot = scratch.keep(hot, "hot")
    if hot.isEmpty():
        return scratch.keep(_judged(distinct.drop("rows")), "judged"), heavy
    # A hot anchor has thousands of segments, so there are few of them per shard.
    windows = scratch.keep(_single_windows(distinct.join(hot, "part", "left_semi")), "windows")
    single = windows.groupBy("seg", "words").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    single = scratch.keep(single, "single")
    frequent = _heavy(single, "seg")
    single = single.select(F.xxhash64("seg").alias("part"), "seg", "words", "n")
    judged = scratch.keep(
        _judged(distinct.join(hot, "part", "left_anti").select("part", "seg", "words", "n").unionByName(single)),
        "judged",
    )
    runs = (
        _split_join(windows.select("owner", "start", "seg"), judged.select("seg"), "seg", frequent)
        .groupBy("owner")
        .agg(F.collect_set("start").alias("starts"))
        .select(
            F.col("owner").alias("seg"),
            F.flatten(
                F.transform(F.array_sort("starts"), lambda s: F.array(s, s + WINDOW))
            ).alias("spans"),
        )
    )
    cold = judged.join(windows.select("seg").distinct(), "seg", "left_anti")
    return cold.unionByName(scratch.keep(runs, "runs")), heavy


def remove_repeated(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    scan = scratch.keep(_scan(docs), "scan")
    texts = scratch.keep(
        scan.where(F.size("anchors") > 0)
        .groupBy("key")
        .agg(F.first("anchors").alias("anchors"), F.count(F.lit(1)).alias("n"))
        .withColumn("id", F.monotonically_increasing_id()),
        "texts",
    )
    common = scratch.keep(_common_anchors(texts, scratch), "common")
    scratch.drop("anchors")
    touched = texts.select("key", "id", "n").join(common, "id")
    nth = F.row_number().over(W.partitionBy("key").orderBy("key"))
    once = (
        docs.select(text_key(F.col("text")).alias("key"), F.col("text").cast("binary").alias("text"))
        .where(F.col("key").isNotNull())
        .withColumn("nth", nth)
        .where("nth = 1")
        .drop("nth")
    )
    wanted = scratch.keep(once.join(touched, "key").select("id", "n", "anchors", "text"), "wanted")
    del once, touched
    scratch.drop("common")
    cut = scratch.keep(_cut_segments(wanted), "cut")
    spans, heavy = _repeated_segments(cut, scratch)
    scratch.drop("hot", "single")
    places = (
        _split_join(cut.select("id", "start", "seg"), spans, "seg", heavy)
        .groupBy("id")
        .agg(F.flatten(F.collect_list(F.transform("spans", lambda s: s + F.col("start")))).alias("spans"))
    )

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            removed, digests = [], []
            for flat, text in zip(batch.column("spans").to_pylist(), as_bytes(batch)):
                words, edges = text.split(), np.array(flat, np.int64).reshape(-1, 2)
                gone = covered(edges[:, 0], edges[:, 1] - edges[:, 0], len(words))
                kept = [w for w, g in zip(words, gone) if not g]
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            return {"n_removed": removed, "kept_sha256": digests}

        return work

    changed = row_pass(
        wanted.select("id", "text").join(places, "id"), "id long, n_removed long, kept_sha256 string", start
    )
    changed = scratch.keep(changed.join(texts.select("id", "key"), "id").drop("id"), "changed")
    scratch.drop("wanted", "cut", "distinct", "heavy", "judged", "windows", "runs", "texts")
    return scan.join(changed, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )
