"""Quality rules: base counts and an n-gram log-likelihood ratio for every text.

Two multinomials over hashed byte n-grams are estimated: one over trusted texts
(the target), one over all texts (the raw corpus). A text's score is the mean log
ratio of its n-grams, target over raw, so it does not depend on the length. The
threshold is the score that all but a share of ``REJECTED`` of the trusted texts
reach. Every text is judged, and the same input gives the same verdicts.

The target and the threshold cover all trusted texts, the raw counts all documents;
each is a sum of bounded size.

A null or empty text has no words, counts of 0, score 0 and fails the base rules.
Without trusted texts both multinomials are the same, and only the base rules
decide. Repeated rows are judged alike. Other columns are ignored or, in
``keep_good``, passed on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import (
    Shared,
    WordHashes,
    as_bytes,
    counted,
    covered,
    ngrams,
    repeated,
    row_filter,
    row_pass,
)

#: Share of the trusted texts that may lie below the threshold.
REJECTED = 0.001
#: Bytes in an n-gram and number of its hash cells.
GRAM, CELLS = 4, 1 << 16
#: Words in a window whose repetition counts, and least number of words.
REPEAT_WINDOW, LEAST_WORDS = 8, 20
#: Scores are compared in steps of this size.
STEP = 1e-3

_SYMBOLS = b"#*$%&|<>"
# Continuation bytes and blanks, which are no characters of words.
_NO_WORD_CHAR = bytes(range(0x80, 0xC0)) + b"\x20\x09\x0a\x0b\x0c\x0d"


@dataclass
class BaseCounts:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > 30 * self.n_words


def base_counts(text: bytes | None, hashes: WordHashes) -> BaseCounts:
    if not text:
        return BaseCounts(0, 0, 0, 0, 0)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    again = 0
    if len(words) > REPEAT_WINDOW:
        grams = ngrams(hashes.of(words), REPEAT_WINDOW)
        starts = np.flatnonzero(repeated(grams))
        if len(starts):
            again = int(covered(starts, REPEAT_WINDOW, len(words)).sum())
    return BaseCounts(
        len(words),
        len(text.translate(None, _NO_WORD_CHAR)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        again,
    )


def gram_cells(text: bytes) -> np.ndarray:
    """Hash cell of every run of GRAM bytes."""
    x = np.frombuffer(text, np.uint8).astype(np.uint32)
    m = len(x) - GRAM + 1
    if m <= 0:
        return np.zeros(0, np.uint32)
    key = x[:m].copy()
    for j in range(1, GRAM):
        key = (key << np.uint32(8)) | x[j : j + m]
    key *= np.uint32(0x9E3779B1)
    return key >> np.uint32(32 - CELLS.bit_length() + 1)


class _GramCount:
    def __init__(self):
        self.total = np.zeros(CELLS, np.int64)

    def __call__(self, batch: pa.RecordBatch) -> None:
        for text in as_bytes(batch):
            if text:
                cells = gram_cells(text)
                if len(cells) > CELLS // 8:
                    self.total += np.bincount(cells, minlength=CELLS)
                else:
                    np.add.at(self.total, cells, 1)


def _score(text: bytes | None, ratio: np.ndarray) -> float:
    cells = gram_cells(text) if text else ()
    return float(ratio[cells].mean()) if len(cells) else 0.0


@dataclass
class Rules:
    """Log ratio of each cell, and the least score that is kept."""

    ratio: np.ndarray
    threshold: float

    def keeps(self, base: BaseCounts, score: float) -> bool:
        return not base.failed and bool(np.floor(score / STEP) >= self.threshold)


def fit(docs: DataFrame, labels: DataFrame) -> Rules:
    # An id labelled both ways is trusted.
    good = labels.where(F.col("quality").cast("int") == 1).select(F.col("doc_id").cast("long").alias("id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where(F.col("text").isNotNull())

    def of_trusted(rows: DataFrame) -> DataFrame:
        # Merged also where the ids would fit a broadcast, so that the plan, and what it
        # shuffles by byte of text, is the same at every size.
        return rows.join(good.hint("merge"), "id", "left_semi").drop("id")

    raw = counted(docs.select("text"), CELLS, _GramCount)
    target = counted(of_trusted(texts), CELLS, _GramCount)
    if not target.any():
        return Rules(np.zeros(CELLS, np.float32), -np.inf)
    log = [np.log((n + 1) / (n.sum() + CELLS)) for n in (target, raw)]
    ratio = (log[0] - log[1]).astype(np.float32)

    def start():
        hashes = WordHashes()

        def work(batch: pa.RecordBatch) -> dict:
            return {
                "step": [
                    None if base_counts(t, hashes).failed else int(np.floor(_score(t, ratio) / STEP))
                    for t in as_bytes(batch)
                ]
            }

        return work

    # All texts are scored where they lie, so that only steps are joined. At most one row
    # per step of the score reaches the driver.
    steps = of_trusted(row_pass(texts, "id long, step long", start).where("step IS NOT NULL"))
    steps = steps.groupBy("step").count().collect()
    reached, below = sum(r["count"] for r in steps), 0
    threshold = -np.inf
    for row in sorted(steps):
        if below > REJECTED * reached:
            break
        threshold = row["step"]
        below += row["count"]
    return Rules(ratio, threshold)


def judge(docs: DataFrame, rules: Rules) -> DataFrame:
    """Counts, score and verdict of every row."""
    shared = Shared(docs.sparkSession, rules)

    def start():
        hashes, rules = WordHashes(), shared.load()

        def work(batch: pa.RecordBatch) -> dict:
            texts = as_bytes(batch)
            base = [base_counts(t, hashes) for t in texts]
            scores = [_score(t, rules.ratio) for t in texts]
            return {
                "n_words": [b.n_words for b in base],
                "word_chars": [b.word_chars for b in base],
                "n_symbols": [b.n_symbols for b in base],
                "n_dup_lines": [b.n_dup_lines for b in base],
                "n_repeat_words": [b.n_repeat_words for b in base],
                "base_failed": [b.failed for b in base],
                "score": scores,
                "kept": [rules.keeps(b, s) for b, s in zip(base, scores)],
            }

        return work

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, score double, kept boolean"
    )
    return row_pass(docs.select(F.col("doc_id").cast("long"), "text"), schema, start)


def keep_good(docs: DataFrame, rules: Rules) -> DataFrame:
    """The rows that the rules keep, unchanged."""
    shared = Shared(docs.sparkSession, rules)

    def start():
        hashes, rules = WordHashes(), shared.load()
        return lambda batch: [
            rules.keeps(base_counts(t, hashes), _score(t, rules.ratio)) for t in as_bytes(batch)
        ]

    return row_filter(docs, start)
