"""Language-model scores of texts: Katz backoff over words.

Counts of one to ``order`` words come from the training texts. Counts up to ``FEW`` are
discounted by Good and Turing's estimate; what that frees for a history goes to the words
never seen after it, in proportion to their probability after the history without its
first word. The share of those words is summed over exactly the words that were seen, so
the probabilities after each history add up to one: over all training tokens and one
class for unknown words, which gets what the discounts of single tokens free.

No task ever holds the model. Texts are packed into chunks of about ``CHUNK`` tokens. A
chunk asks for each of its different n-grams once, sorted into buckets by hash; a bucket
merges what all chunks tell of an n-gram, which is its part of the count table, and
answers each of them. Histories are asked in the same way, with the discounted counts
and lower probabilities that a chunk adds to them (an n-gram that several chunks hold
is added by one of them). So a frequent n-gram is one entry per chunk, a bucket is a
bounded number of entries, and a chunk then evaluates its tokens one order after the
other with the answers it got.

Where Good and Turing's estimate is not defined (a count of counts is zero, or a
discount is outside 0 to 1), an absolute discount is used. A history whose counts are
all above ``FEW`` frees nothing; it counts one token more, which its unseen words share.
Without any training text every token is unknown and has probability one.

A null text has no words, like an empty one: its score is that of the end token. Ids may
be null or repeated (a null id counts as the empty text for the held-out fold), repeated
texts count as often as they occur, very long texts are chunks of their own, and order
plays no part, so there are no ties. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import Scratch, WordHashes, as_bytes, fold, mixed, row_pass

FOLDS, HELD_OUT = 5, 1
ORDER = 2
#: Counts that are discounted.
FEW = 5
#: Tokens of a chunk (one text at least), and entries of a bucket, about.
CHUNK, BUCKET = 1 << 20, 1 << 21
#: A history whose freed share is below this has only counts above ``FEW``.
NOTHING = 1e-9
# Words have no blanks, so these are none.
END, BEGIN = (np.uint64(xxhash.xxh3_64_intdigest(mark)) for mark in (b" end", b" begin"))
STEP = np.uint64(0x9E3779B97F4A7C15)

ANSWER = "bucket int, chunk long, kind int, data binary, stats array<long>"


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, first bytes first."""
    n = len(values)
    width = (int(values.max()).bit_length() + 7) // 8 if n else 0
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(n, 8)[:, :width].T
    return bytes([width]) + planes.tobytes() + (n.to_bytes(8, "little") if not width else b"")


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    if not width:
        return np.zeros(int.from_bytes(data[1:9], "little"), np.uint64)
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel().astype(np.uint64, copy=False)


def packed_keys(keys: np.ndarray) -> bytes:
    """Keys in order, by what each adds to the one before."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def discounts(n: list[int]) -> np.ndarray:
    """Factor of each count from 0 to ``FEW``; ``n``: how many n-grams have 1, 2, ..."""
    factors = np.ones(FEW + 1)
    if all(n[: FEW + 1]):
        rest = (FEW + 1) * n[FEW] / n[0]
        for r in range(1, FEW + 1):
            factors[r] = ((r + 1) * n[r] / (r * n[r - 1]) - rest) / (1 - rest) if rest < 1 else 0
        if (factors[1:] > 0).all() and (factors[1:] < 1).all():
            return factors
    off = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    factors[1:] = 1 - off / np.arange(1, FEW + 1)
    return factors


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= FEW, factors[np.minimum(counts, FEW)], 1.0)


class Unigrams:
    """Probabilities of single tokens."""

    def __init__(self, different: int, total: int, n: list[int]):
        self.different, self.total = different, total
        self.factors = discounts(n)
        free = sum(r * n[r - 1] * (1 - self.factors[r]) for r in range(1, FEW + 1))
        self.all = total if free > NOTHING * total else total + 1
        self.unknown = (self.all - total + free) / self.all

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.factors) / self.all, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.different + 1)))


class Chunk:
    """Tokens of some texts, and their different n-grams in hash order."""

    def __init__(self, data: bytes):
        content = pickle.loads(zlib.decompress(data))
        self.doc_ids, self.held_out = content["doc_ids"], content["held_out"]
        self.vocabulary = unpacked_keys(content["vocabulary"])
        self.lengths = content["lengths"]
        by_rank = unpacked(content["by_rank"]).astype(np.int64)
        self.tokens = by_rank[unpacked(content["ranks"]).astype(np.int64)]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.train = np.repeat(~self.held_out, self.lengths)
        self._distance = np.arange(len(self.tokens)) - np.repeat(self.starts, self.lengths)
        self._grams: dict[int, tuple] = {}

    def _hashes(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each token, hash of the ``order - 1`` tokens before it, and with it."""
        words = self.vocabulary[self.tokens]
        history = np.full(len(words), np.uint64(order))
        for back in range(order - 1, 0, -1):
            earlier = np.full(len(words), BEGIN)
            inside = np.flatnonzero(self._distance >= back)
            earlier[inside] = words[inside - back]
            history = mixed(history * STEP + earlier)
        return history, mixed(history * STEP + words)

    def grams(self, order: int) -> tuple:
        """Keys in order, number of each token's key, keys of histories, number of each
        key's history, number of the next shorter n-gram of each key."""
        if order not in self._grams:
            if order == 1:
                none = np.zeros(0, np.int64)
                self._grams[1] = self.vocabulary, self.tokens, none, none, none
            else:
                history, whole = self._hashes(order)
                keys, first, number = np.unique(whole, return_index=True, return_inverse=True)
                histories, of = np.unique(history[first], return_inverse=True)
                shorter = self.grams(order - 1)[1][first]
                self._grams[order] = keys, number, histories, of, shorter
        return self._grams[order]

    def counts(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        keys, number, *_ = self.grams(order)
        return keys, np.bincount(number[self.train], minlength=len(keys))


class _Pack:
    """Packs texts into chunks."""

    def __init__(self):
        self.hashes, self.rows, self.size = WordHashes(), [], 0

    def __call__(self, batch: pa.RecordBatch) -> dict | None:
        out = []
        columns = (batch.column(n).to_pylist() for n in ("rid", "doc_id", "held_out"))
        for rid, doc_id, held_out, text in zip(*columns, as_bytes(batch)):
            # bytes.lower() changes A to Z only, bytes.split() cuts at the same six characters.
            words = self.hashes.of((text or b"").lower().split())
            if self.size + len(words) >= CHUNK:
                out += self.flush()
            self.rows.append((rid, doc_id, held_out, words))
            self.size += len(words) + 1
        return self.columns(out)

    def flush(self) -> list[tuple]:
        if not self.rows:
            return []
        rids, doc_ids, held_out, texts = zip(*self.rows)
        words = np.concatenate([part for text in texts for part in (text, [END])]).astype(np.uint64)
        vocabulary, tokens, counts = np.unique(words, return_inverse=True, return_counts=True)
        # Frequent words get small numbers, whose upper bytes are mostly zero.
        by_rank = np.argsort(-counts, kind="stable")
        ranks = np.empty(len(by_rank), np.int64)
        ranks[by_rank] = np.arange(len(by_rank))
        content = {
            "doc_ids": doc_ids,
            "held_out": np.array(held_out, bool),
            "lengths": np.array([len(t) + 1 for t in texts]),
            "vocabulary": packed_keys(vocabulary),
            "by_rank": packed(by_rank),
            "ranks": packed(ranks[tokens]),
        }
        self.rows, self.size = [], 0
        return [(rids[0], len(words), zlib.compress(pickle.dumps(content, 5), 1))]

    @staticmethod
    def columns(rows: list[tuple]) -> dict | None:
        return dict(zip(("chunk", "size", "data"), map(list, zip(*rows)))) if rows else None


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows one by one; binary values stay in the batch's memory until they are read."""
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for i in range(batch.num_rows):
            yield tuple(
                c[i].as_buffer().to_pybytes() if pa.types.is_binary(c.type) and c[i].is_valid else c[i].as_py()
                for c in columns
            )


def _grouped(rows: Iterator[tuple]) -> Iterator[tuple[object, list[tuple]]]:
    """Consecutive rows with the same first value."""
    key, group = None, []
    for first, *rest in rows:
        if group and first != key:
            yield key, group
            group = []
        key = first
        group.append(rest)
    if group:
        yield key, group


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
    )


_REQUEST = pa.schema(
    [("bucket", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("data", pa.binary())]
)
_ANSWER = pa.schema(
    [
        ("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("data", pa.binary()),
        ("stats", pa.list_(pa.int64())),
    ]
)


class Model:
    """The exchange between chunks and buckets, one order after the other."""

    def __init__(self, docs: DataFrame, order: int, held_out, scratch: Scratch):
        """``held_out``: condition on the rows of ``docs`` that are not learnt from."""
        self.order, self.scratch = order, scratch
        rows = docs.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col("doc_id").cast("long").alias("doc_id"),
            held_out.alias("held_out"),
            "text",
        )
        packing = row_pass(
            rows, "chunk long, size long, data binary", _Pack, lambda pack: pack.columns(pack.flush())
        )
        self.chunks = scratch.keep(packing, "chunks")
        size = self.chunks.agg(F.sum("size")).first()[0] or 0
        self.bits = max(0, int(np.ceil(np.log2(max(size, 1) / BUCKET))))
        self.answers: list[DataFrame] = []
        self.factors: list[np.ndarray] = []
        for k in range(1, order + 1):
            self._count(k)
            scratch.free()
            if k > 1:
                self._weigh(k)
                scratch.free()

    def _gathered(self, with_answers: bool) -> DataFrame:
        """Chunks, each together with the answers it got where these are needed."""
        rows = self.chunks.select(
            F.lit(0).alias("bucket"), "chunk", F.lit(0).alias("kind"), "data"
        )
        if not with_answers:
            return rows
        for answer in self.answers:
            given = answer.where(F.col("chunk").isNotNull())
            rows = rows.unionByName(given.select("bucket", "chunk", "kind", "data"))
        return rows.repartition("chunk").sortWithinPartitions("chunk", "kind", "bucket")

    def _per_chunk(
        self, work: Callable, schema: pa.Schema, ddl: str, with_answers: bool = True
    ) -> DataFrame:
        """``work(id, chunk, answers by kind)`` gives rows of a chunk."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk, rows in _grouped(_rows(batches, "chunk", "kind", "data")):
                answers: dict[int, list] = {}
                for kind, data in rows[1:]:
                    answers.setdefault(kind, []).append(data)
                yield _batch(schema, work(chunk, Chunk(rows[0][1]), answers))

        return self._gathered(with_answers).mapInArrow(run, ddl)

    def _ask(self, make: Callable, reply: Callable, name: str, with_answers: bool) -> list[int]:
        """Adds a table of answers; returns the sums of what the buckets say of themselves.

        ``make(chunk, answers)`` gives keys in order and data of each as a function of
        a slice; ``reply(requests)`` gives a bucket's answers and its statistics."""
        bits = self.bits

        def requests(chunk_id: int, chunk: Chunk, answers: dict) -> list[tuple]:
            keys, data = make(chunk, answers)
            edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else []
            cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
            return [
                (b, chunk_id, packed_keys(keys[i:j]), data(slice(i, j)))
                for b, (i, j) in enumerate(zip(cuts, cuts[1:]))
                if j > i
            ]

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, rows in _grouped(_rows(batches, "bucket", "chunk", "keys", "data")):
                chunks, kind, answers, stats = reply(rows)
                out = [(bucket, c, kind, a, None) for c, a in zip(chunks, answers)]
                yield _batch(_ANSWER, [*out, (bucket, None, kind, None, stats)])

        ddl = "bucket int, chunk long, keys binary, data binary"
        asked = self._per_chunk(requests, _REQUEST, ddl, with_answers)
        asked = asked.repartition("bucket").sortWithinPartitions("bucket", "chunk")
        answered = self.scratch.keep(asked.mapInArrow(answer, ANSWER), name)
        self.answers.append(answered)
        sums = answered.where("chunk is null").select(F.posexplode("stats").alias("i", "n"))
        return [row.n for row in sums.groupBy("i").agg(F.sum("n").alias("n")).orderBy("i").collect()]

    def _count(self, k: int) -> None:
        def make(chunk: Chunk, answers: dict):
            keys, counts = chunk.counts(k)
            return keys, lambda part: packed(counts[part])

        def reply(rows: list):
            keys = [unpacked_keys(r[1]) for r in rows]
            told = _joined([r[2] for r in rows])
            different, number = np.unique(np.concatenate(keys), return_inverse=True)
            counts = np.zeros(len(different), np.int64)
            np.add.at(counts, number, told)
            # The first chunk that counted an n-gram adds it to its history.
            owner = np.zeros(len(number), np.int64)
            having = np.flatnonzero(told > 0)
            owner[having[np.unique(number[having], return_index=True)[1]]] = 1
            values = 2 * counts[number] + owner
            cuts = np.cumsum([0, *map(len, keys)])
            few = np.bincount(counts[counts <= FEW + 1], minlength=FEW + 2)
            stats = [int((counts > 0).sum()), int(counts.sum()), *few[1:].tolist()]
            return [r[0] for r in rows], 2 * k, [packed(values[a:b]) for a, b in zip(cuts, cuts[1:])], stats

        stats = self._ask(make, reply, f"counts{k}", False) or [0] * (FEW + 3)
        if k == 1:
            self.unigrams = Unigrams(stats[0], stats[1], stats[2:])
            self.factors.append(self.unigrams.factors)
        else:
            self.factors.append(discounts(stats[2:]))

    def _weigh(self, k: int) -> None:
        unigrams, factors = self.unigrams, list(self.factors)

        def make(chunk: Chunk, answers: dict):
            evaluated = Evaluation(chunk, answers, unigrams, factors, k - 1)
            _, _, histories, of, shorter = chunk.grams(k)
            told = _joined(answers[2 * k])
            own = np.flatnonzero(told & 1)
            counts = told[own] >> 1
            parts = (counts, discounted(counts, factors[k - 1]), 10 ** evaluated.logs[k - 1][shorter[own]])
            total, *sums = (np.bincount(of[own], p, minlength=len(histories)) for p in parts)
            return histories, lambda part: _mixed(total[part], *(x[part] for x in sums))

        def reply(rows: list):
            keys = [unpacked_keys(r[1]) for r in rows]
            told = [np.concatenate(column) for column in zip(*(_unmixed(r[2], 2) for r in rows))]
            different, number = np.unique(np.concatenate(keys), return_inverse=True)
            total, kept, lower = (np.bincount(number, t, minlength=len(different)) for t in told)
            free = total - kept
            tight = free <= NOTHING * total
            all_ = np.where(tight, total + 1, total)
            free = np.where(tight, 1.0, free)
            seen = total > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                weight = np.where(seen, np.log10(free / all_ / (1 - lower)), 0.0)
            size, weight = np.where(seen, all_, 1)[number], weight[number]
            cuts = np.cumsum([0, *map(len, keys)])
            data = [_mixed(size[a:b], weight[a:b]) for a, b in zip(cuts, cuts[1:])]
            return [r[0] for r in rows], 2 * k + 1, data, [int(seen.sum())]

        self._ask(make, reply, f"weights{k}", True)

    def scores(self) -> DataFrame:
        unigrams, factors, order = self.unigrams, list(self.factors), self.order
        ddl = (
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double"
        )
        kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2]
        schema = pa.schema([(f.split()[0], kind) for f, kind in zip(ddl.split(", "), kinds)])

        def work(_, chunk: Chunk, answers: dict) -> list[tuple]:
            evaluated = Evaluation(chunk, answers, unigrams, factors, order)
            counts = evaluated.counts
            number = chunk.grams(order)[1]
            columns = [
                (counts > 0).astype(np.int64)[chunk.tokens],
                unigrams.base(counts)[chunk.tokens],
                evaluated.logs[order][number],
            ]
            known, base, score = (np.add.reduceat(c, chunk.starts).tolist() for c in columns)
            n = len(chunk.lengths)
            held = chunk.held_out.tolist()
            return list(zip(chunk.doc_ids, held, chunk.lengths.tolist(), known, [unigrams.total] * n, base, score))

        return self._per_chunk(work, schema, ddl)


def _joined(blobs: list[bytes]) -> np.ndarray:
    return np.concatenate([unpacked(b) for b in blobs]).astype(np.int64)


def _mixed(whole: np.ndarray, *numbers: np.ndarray) -> bytes:
    """A column of whole numbers and columns of others of the same length."""
    others = b"".join(n.astype(np.float64).tobytes() for n in numbers)
    return len(whole).to_bytes(8, "little") + others + packed(whole.astype(np.uint64))


def _unmixed(data: bytes, numbers: int) -> list[np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    others = np.frombuffer(data, np.float64, numbers * n, offset=8).reshape(numbers, n)
    return [unpacked(data[8 + 8 * numbers * n :]), *others]


class Evaluation:
    """Log probability of each different n-gram of a chunk, from the shortest up."""

    def __init__(self, chunk: Chunk, answers: dict, unigrams: Unigrams, factors: list, order: int):
        self.counts = _joined(answers[2]) >> 1
        self.logs = {1: np.log10(unigrams.probability(self.counts))}
        for k in range(2, order + 1):
            *_, of, shorter = chunk.grams(k)
            counts = _joined(answers[2 * k]) >> 1
            size, weight = map(np.concatenate, zip(*(_unmixed(b, 1) for b in answers[2 * k + 1])))
            with np.errstate(divide="ignore"):
                direct = np.log10(discounted(counts, factors[k - 1])) - np.log10(size.astype(np.float64))[of]
            self.logs[k] = np.where(counts > 0, direct, weight[of] + self.logs[k - 1][shorter])


def score(docs: DataFrame, scratch: Scratch, order: int = ORDER) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every
    row; the held-out fold is not learnt from."""
    return Model(docs, order, fold(F.col("doc_id"), FOLDS) == HELD_OUT, scratch).scores()
