"""Language identification by error-correcting output codes.

Each language gets a codeword. For every bit, a binary classifier over hashed byte
n-grams tells the languages with a 1 from those with a 0: its weights are the log
ratios of the two mean multinomials, its margin is the mean weight of a text's
n-grams. A text's margins are compared with all codewords by logistic loss, each
bit weighted by how often it is right for that language, and the codeword with the
least loss wins. If the next one is close, the text is flagged as ambiguous.

Multinomials are counted over all training rows; the bits' weights are measured on
at most ``WEIGHT_ROWS`` of them. Training rows have a language and lie outside the
held-out fold. Ids, sources and the languages of scored rows are not inputs.

A text that is null or has no letter is ``und`` with score 0, as is every text
when there are no training rows or the table is empty. Languages are the distinct values
of ``lang``, taken as they are, the ``MOST_LANGUAGES`` most frequent of them; of equally
frequent ones, and of equally near codewords, the first by code point. Repeated rows
count as often as they occur; very long texts count whole, by the mean of their n-grams.
Other columns are ignored.
"""

from __future__ import annotations

from itertools import product
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import Shared, as_bytes, counted, fold, row_pass

FOLDS, HELD_OUT = 3, 1
#: Most training rows the weights of the bits are measured on.
WEIGHT_ROWS = 20_000
GRAM, CELLS = 3, 1 << 15
#: Most values of ``lang`` that are learnt, the most frequent ones: what is counted is this
#: many times ``CELLS`` numbers, also where the column holds junk. Rows of others are scored.
MOST_LANGUAGES = 256
#: Languages up to which all codeword columns are used, and columns per bit beyond.
EXHAUSTIVE, COLUMNS = 6, 12
#: Steepness of the loss; share of the loss by which the next codeword must be worse.
STEEP, AMBIGUOUS = 8.0, 0.2
UNKNOWN = "und"

_NO_LETTERS = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else 32 for c in range(256))


def gram_cells(text: str | None) -> np.ndarray | None:
    """Hash cells of the n-grams of a text's letters; None without letters."""
    if not text or not any(map(str.isalpha, text)):
        return None
    words = text.lower().encode().translate(_NO_LETTERS).split()
    x = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    m = len(x) - GRAM + 1
    if m <= 0:
        return np.zeros(0, np.uint32)
    key = x[:m].copy()
    for j in range(1, GRAM):
        key = (key << np.uint32(8)) | x[j : j + m]
    key *= np.uint32(0x9E3779B1)
    return key >> np.uint32(32 - CELLS.bit_length() + 1)


def codewords(languages: int) -> np.ndarray:
    """Rows of -1 and 1, one per language; no column has the same bit throughout."""
    if languages < 2:
        return np.ones((languages, 1), np.int64)
    if languages <= EXHAUSTIVE:
        rows = [bits for bits in product((-1, 1), repeat=languages) if bits[0] == 1 and -1 in bits]
        return np.array(rows).T
    # Halves of the languages, each told from the rest once: there are no more columns.
    halves = comb(languages, languages // 2) // (2 if languages % 2 == 0 else 1)
    wanted = min(halves, COLUMNS * int(np.ceil(np.log2(languages))))
    random, columns = np.random.default_rng(languages), []
    while len(columns) < wanted or len({row.tobytes() for row in np.array(columns).T}) < languages:
        column = np.where(random.permutation(languages) % 2, 1, -1)
        if all(abs(int(column @ c)) < languages for c in columns):
            columns.append(column)
    return np.array(columns).T


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray):
        """``counts``: n-grams by language and cell."""
        self.languages, self.code = languages, codewords(len(languages))
        share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        weights = []
        for bits in self.code.T if len(languages) > 1 else ():
            weights.append(np.log(share[bits > 0].mean(axis=0)) - np.log(share[bits < 0].mean(axis=0)))
        self.weights = np.array(weights, np.float32).reshape(-1, CELLS).T.copy()
        self.trust = np.ones(self.code.shape) / self.code.shape[1]

    def margins(self, cells: np.ndarray) -> np.ndarray:
        if not len(cells):
            return np.zeros(self.weights.shape[1])
        if len(cells) > CELLS // 4:
            counts = np.bincount(cells, minlength=CELLS).astype(np.float32)
            return (counts @ self.weights) / len(cells)
        return self.weights[cells].mean(axis=0)

    def losses(self, cells: np.ndarray) -> np.ndarray:
        if len(self.languages) < 2:
            return np.zeros(len(self.languages))
        margins = STEEP * self.margins(cells)
        return (self.trust * np.logaddexp(0, -self.code * margins)).sum(axis=1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, whether another one is close."""
        cells = gram_cells(text)
        if cells is None or not self.languages:
            return UNKNOWN, 0.0, False
        losses = self.losses(cells)
        share = np.exp(-STEEP * (losses - losses.min()))
        order = np.argsort(losses, kind="stable")
        close = len(order) > 1 and losses[order[1]] - losses[order[0]] < AMBIGUOUS * losses[order[1]]
        return self.languages[order[0]], float(1 / share.sum()), bool(close)


class _GramCount:
    def __init__(self, languages: list[str]):
        self.number = {lang: i for i, lang in enumerate(languages)}
        self.total = np.zeros(len(languages) * CELLS, np.int64)

    def __call__(self, batch: pa.RecordBatch) -> None:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            cells = gram_cells(text)
            if cells is not None:
                own = self.total[self.number[lang] * CELLS :][:CELLS]
                if len(cells) > CELLS // 8:
                    own += np.bincount(cells, minlength=CELLS)
                else:
                    np.add.at(own, cells, 1)


class _BitCount:
    """Texts by language, and how often each bit of theirs was right."""

    def __init__(self, model: Model):
        self.model = model
        self.number = {lang: i for i, lang in enumerate(model.languages)}
        self.rows = np.zeros((len(model.languages), model.code.shape[1] + 1), np.int64)

    @property
    def total(self) -> np.ndarray:
        return self.rows.ravel()

    def __call__(self, batch: pa.RecordBatch) -> None:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            cells = gram_cells(text)
            if cells is not None:
                i = self.number[lang]
                self.rows[i, 0] += 1
                self.rows[i, 1:] += self.model.margins(cells) * self.model.code[i] > 0


def fit(docs: DataFrame) -> Model:
    spark = docs.sparkSession
    lang = F.col("lang").cast("string").alias("lang")
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    rows = known.select("text", lang)
    frequent = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES + 1)
    found = [r.lang for r in frequent.collect()]
    languages = sorted(found[:MOST_LANGUAGES])
    if not languages:
        return Model([], np.zeros((0, CELLS), np.int64))
    if len(found) > MOST_LANGUAGES:
        known = known.where(lang.isin(languages))
        rows = known.select("text", lang)
    counts = counted(rows, len(languages) * CELLS, lambda: _GramCount(languages))
    model = Model(languages, counts.reshape(len(languages), CELLS))
    if len(languages) > 1:
        ids = known.select(F.col("doc_id").alias("id")).where(F.col("id").isNotNull())
        ids = ids.distinct().orderBy(F.xxhash64("id"), "id").limit(WEIGHT_ROWS)
        sample = known.join(F.broadcast(ids), F.col("doc_id") == F.col("id"), "left_semi")
        shared = Shared(spark, model)
        width = model.code.shape[1] + 1
        right = counted(
            sample.select("text", lang), len(languages) * width, lambda: _BitCount(shared.load())
        ).reshape(-1, width)
        trust = (right[:, 1:] + 1) / (right[:, :1] + 2)
        model.trust = trust / trust.sum(axis=1, keepdims=True)
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` of every row."""
    shared = Shared(docs.sparkSession, model)

    def start():
        model = shared.load()

        def work(batch: pa.RecordBatch) -> dict:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            return {
                "lang_pred": [f[0] for f in found],
                "score": [f[1] for f in found],
                "ambiguous": [f[2] for f in found],
            }

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "text",
    )
    schema = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
    return row_pass(rows, schema, start)
