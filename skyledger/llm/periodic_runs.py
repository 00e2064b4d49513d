"""Periodic runs: stretches of words that repeat themselves at a fixed distance.

Periods are searched by octave: those from ``B`` to ``2B - 1`` in tiles around the
words whose number is a multiple of ``B``. A tile reaches ``REACH * B`` words to both
sides of its boundary, so neighbouring tiles overlap and their width grows with the
octave. A tile is solved by itself: where the ``B`` words after the boundary come again
at a distance of the octave, Z-functions forward from the boundary and backward from it
say how far the words equal those one period on. Only pieces long enough to belong to a
run are kept, and only those whose period is not a multiple of a shorter one. Pieces are
shuffled by document and period and stitched there: overlapping pieces are one run.

Every word of a run of period ``q`` lies in a tile of its octave together with at least
``min(REACH * B, what there is)`` of it on each side, so no run is missed and each is
found whole, however long the document. The work is in proportion to its words times
the number of octaves, of which a document of ``n`` words has ``log2(n / 4)``.

A run has length ``max(6, 4 * period)`` at least. Words are numbered from 0; a null text
has none, like an empty one. Repeated rows are each judged alone, rows with a null id
too, and other columns are ignored. An empty table gives no rows. Of equally long runs
the first is the longest, then the one of the shortest period.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.llm.common import Scratch, as_bytes, row_pass

LEAST, TIMES = 6, 4
#: Half the width of a tile in boundaries; more than a run's equal words per octave.
REACH = 6
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Numbers(dict):
    """Different words to different numbers, anew for each text."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self) + 1
        return value


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Which original word stands at each place, where the rule of every tenth id makes
    a text periodic; a null id counts as the empty text."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    start = g % n
    places = np.arange(n)
    places[start:] = start + (places[start:] - start) % (1 + (n - start) // (3 + g % 8))
    return places


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from it on equal those from the start on."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def needed(period: int) -> int:
    """Words of a run that equal the one a period later, at least."""
    return max(LEAST, TIMES * period) - period


class Rolling:
    """Hashes of all stretches of a given number of words, from one pass over them."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.power = np.full(n + 1, MULTIPLIER, np.uint64)
        self.power[0] = 1
        np.cumprod(self.power, out=self.power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * self.power[1:], out=self.sums[1:])

    def stretches(self, size: int) -> np.ndarray:
        last = len(self.sums) - 1 - size
        return (self.sums[size:] - self.sums[:-size]) * self.power[last::-1]


def boundaries(rolling: Rolling, octave: int) -> np.ndarray:
    """Boundaries after which ``octave`` words come again one period of the octave on.
    Compared by hashes: one may be wrong, none is missed."""
    hashes = rolling.stretches(octave)
    after = hashes[octave:]
    tiles = -(-len(after) // octave)
    later = np.zeros((tiles, octave), np.uint64)
    later.ravel()[: len(after)] = after
    same = later == hashes[: tiles * octave : octave, None]
    same.ravel()[len(after) :] = False
    return np.flatnonzero(same.any(axis=1)) * octave


def solve(words: np.ndarray, boundary: int, octave: int) -> list[tuple[int, int, int]]:
    """``period, from, to``: the words of the tile around a boundary that equal the one a
    period later, for periods of the octave that are not multiples of shorter ones."""
    reach = REACH * octave
    before = words[max(0, boundary - reach) : boundary][::-1].tolist()
    after = words[boundary : boundary + reach + 2 * octave].tolist()
    ahead = z_function(after)
    periods = [q for q in range(octave, min(2 * octave, len(ahead))) if ahead[q] >= octave]
    if not periods:
        return []
    # Words before the boundary, backward, against those before the boundary plus period.
    z = z_function([*before, None, *after[2 * octave - 1 :: -1], *before])
    end = len(before) + 1 + min(2 * octave, len(after))
    pieces = []
    for q in periods:
        forward, behind = min(ahead[q], reach), min(z[end - q], len(before))
        if forward + behind < needed(q):
            continue
        shortest = next(d for d in range(1, q + 1) if ahead[d] + d >= q + forward)
        if shortest == q or q % shortest:
            pieces.append((q, boundary - behind, boundary + forward))
    return pieces


def pieces_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``period, from, to`` of all tiles of one text."""
    found, octave = [], 1
    if len(words) < LEAST:
        return found
    rolling = Rolling(words)
    while TIMES * octave <= len(words):
        for boundary in boundaries(rolling, octave).tolist():
            found += solve(words, boundary, octave)
        octave *= 2
    return found


class _Tiles:
    """Row of a text, followed by its pieces; a text with pieces keeps its words."""

    def __call__(self, batch: pa.RecordBatch) -> dict:
        out = {name: [] for name in ("rid", "doc_id", "n", "words", "sha", "period", "low", "high")}
        ids, docs = batch.column("rid").to_pylist(), batch.column("doc_id").to_pylist()
        for rid, doc_id, text in zip(ids, docs, as_bytes(batch)):
            words = (text or b"").split()
            numbers = Numbers()
            coded = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
            places = planted(len(words), doc_id)
            if places is not None:
                words, coded = [words[i] for i in places.tolist()], coded[places]
            pieces, joined = pieces_of(coded), b" ".join(words)
            sha = None if pieces else hashlib.sha256(joined).hexdigest()
            rows = [(rid, doc_id, len(words), joined if pieces else None, sha, None, None, None)]
            rows += [(rid, None, None, None, None, *piece) for piece in pieces]
            for values, column in zip(zip(*rows), out.values()):
                column += values
        return out


class _Collapse:
    """Results of texts that have runs."""

    def __call__(self, batch: pa.RecordBatch) -> dict:
        out = {name: [] for name in RUN_COLUMNS}
        out["collapsed_sha256"] = []
        texts = batch.column("words").to_pylist()
        for text, runs in zip(texts, batch.column("runs").to_pylist()):
            words = text.split(b" ")
            runs = [(r["start"], r["period"], r["length"]) for r in runs]
            start, period, length = min(runs, key=lambda r: (-r[2], r[0], r[1]))
            dropped = np.zeros(len(words) + 1, np.int64)
            for s, q, n in runs:
                dropped[s + q] += 1
                dropped[s + n] -= 1
            kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
            lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
            collapsed = b" ".join([words[i] for i in kept.tolist()])
            values = (len(runs), start, length, period, 1000 * length // period,
                      hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())
            for value, column in zip(values, out.values()):
                column.append(value)
        return out


RUN_COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256"]


def stitched(pieces: DataFrame) -> DataFrame:
    """``rid, period, start, length`` of the runs that overlapping pieces make up."""
    along = W.partitionBy("rid", "period").orderBy("low")
    reached = F.max("high").over(along.rowsBetween(W.unboundedPreceding, -1))
    new = F.coalesce(F.col("low") > reached, F.lit(True)).cast("int")
    runs = pieces.withColumn("new", new).withColumn("run", F.sum("new").over(along))
    runs = runs.groupBy("rid", "period", "run").agg(F.min("low").alias("start"), F.max("high").alias("to"))
    return runs.select("rid", "period", "start", (F.col("to") - F.col("start") + F.col("period")).alias("length"))


def periodic_runs(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id``, the number of runs, the longest one, digests of all runs and of the
    words that are left when of each run only the first period is kept."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    schema = "rid long, doc_id long, n long, words binary, sha string, period long, low long, high long"
    found = scratch.keep(row_pass(rows, schema, _Tiles), "pieces")
    runs = stitched(found.where(F.col("period").isNotNull()).select("rid", "period", "low", "high"))
    runs = runs.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))

    texts = found.where(F.col("period").isNull())
    periodic = texts.where(F.col("words").isNotNull()).join(runs, "rid").select("doc_id", "words", "runs")
    result = (
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string"
    )
    none = F.lit(None).cast("long")
    plain = texts.where(F.col("words").isNull()).select(
        "doc_id",
        F.lit(0).cast("long").alias("n_runs"),
        *(none.alias(name) for name in RUN_COLUMNS[1:-1]),
        F.sha2(F.lit(""), 256).alias("runs_sha256"),
        F.col("sha").alias("collapsed_sha256"),
    )
    return plain.unionByName(row_pass(periodic, result, _Collapse))
