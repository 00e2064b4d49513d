"""Toxic spans by a linear-chain conditional random field.

Tokens are words in lower case. In a labelled toxic text those tokens are marked
toxic that have a feature (the word, a prefix, a suffix) found almost only in toxic
texts, more than chance explains; all others are clean. A two-label CRF is fitted to these token labels by
L-BFGS until the gradient is small; each step is a job whose partitions send their
loss and the sums of expected minus observed features. Forward-backward marginals of
every token of a text then give its spans (runs of tokens more likely toxic than not,
as code point offsets) and its evidence: the sum of the marginal odds, less what clean
texts of that many tokens have, so that length alone is no evidence. A logistic curve
makes the score of it.

A chain is at most ``CHAIN`` consecutive tokens; longer texts are several chains,
and all their tokens count.

It is fitted on at most ``FIT_ROWS`` labelled ids outside the held-out fold; every
text is scored. Ids, languages and sources are not inputs.

Null and empty texts have no tokens and get the score of a text without toxic
evidence. Without labelled rows every score is 0. Repeated rows are scored alike.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import Scratch, Shared, as_bytes, counted, fold, labelled_sample, row_pass, runs_of

#: Most labelled ids the field is fitted on.
FIT_ROWS = 8_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
CHAIN = 64
#: Hash cells of token features; words a task remembers; bytes of text tagged at once.
CELLS, KNOWN_WORDS, RUN_BYTES = 1 << 18, 1 << 18, 1 << 20
#: A feature marks tokens if toxic texts have it so much more often, by share of
#: texts, and if the likelihood ratio test is beyond what chance gives so many features.
MARK_SHARE, MARK_TEST = 0.98, 20.0
#: Pull of the weights to zero; the fit ends when the gradient is no longer than this
#: share of the toxic tokens; past steps that shape the next one.
RIDGE, SMALL, MEMORY = 0.1, 0.001, 10
#: Greatest log odds that are added up, steps of the evidence in the calibration, and
#: standard deviations above the mean that clean texts are granted.
ODDS, ODDS_STEPS, DEVIATIONS = 12.0, 20, 4.0

# Lower-cases A-Z; blanks for the other ASCII characters that are not in words.
FOLDED = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32
    for c in range(256)
)
_TOKEN = re.compile(rb"[^ ]+")


def word_cells(word: bytes) -> list[int]:
    """Hash cells of a token's features."""
    parts = (b"w" + word, b"3" + word[:3], b"4" + word[:4], b"5" + word[:5], b"s" + word[-3:])
    return [xxhash.xxh3_64_intdigest(p) & (CELLS - 1) for p in parts]


FEATURES = 5


class Vocabulary(dict):
    """Word to number; ``rows`` has the feature cells by number."""

    def __init__(self):
        self.rows: list[list[int]] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self.rows)
        self.rows.append(word_cells(word))
        return len(self.rows) - 1

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class Evidence(dict):
    """Word to its log odds by itself; remembers a bounded number of words."""

    def __init__(self, field: Field):
        self.weights = field.weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = float(self.weights[word_cells(word)].sum() + self.weights[-1])
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.float64, len(words))


class Chains:
    """The tokens of some texts, by number or evidence, dealt to chains."""

    def __init__(self, lengths: np.ndarray, tokens: np.ndarray):
        self.lengths, self.tokens = lengths, tokens
        self.text = np.repeat(np.arange(len(lengths)), self.lengths)
        first = np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        place = np.arange(len(self.tokens)) - first
        chains = -(-self.lengths // CHAIN)
        self.chain = (np.cumsum(chains) - chains)[self.text] + place // CHAIN
        self.step = place % CHAIN
        self.shape = (CHAIN, int(chains.sum()))
        self.there = np.zeros(self.shape, bool)
        self.there[self.step, self.chain] = True

    @staticmethod
    def of(texts: list[bytes | None], table: Vocabulary | Evidence) -> Chains:
        each = [table.of(t.translate(FOLDED).split() if t else []) for t in texts]
        tokens = np.concatenate(each) if each else np.zeros(0)
        return Chains(np.array([len(e) for e in each], np.int64), tokens)

    def spread(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.shape)
        out[self.step, self.chain] = values
        return out


class Field:
    """Weights of features for the toxic label, its bias, and log potentials of the
    transitions between clean (0) and toxic (1)."""

    def __init__(self):
        self.weights = np.zeros(CELLS + 1)  # the bias is last
        self.moves = np.zeros((2, 2))
        self.clean = (0.0, 0.0)  # odds of a token of clean texts, and their variance
        self.curve = (0.0, -50.0)  # scores of 0 until calibrated

    def log_odds(self, chains: Chains, evidence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginal log odds of the tokens, and the forward and backward parts of the
        pairs of neighbours. Messages are kept as log ratios of toxic to clean."""
        own = chains.spread(evidence)
        (p00, p01), (p10, p11) = np.exp(self.moves)
        ahead, back = np.zeros(chains.shape), np.zeros(chains.shape)
        for t in range(CHAIN):
            if t:
                x = np.exp(ahead[t - 1])
                ahead[t] = np.log((p01 + x * p11) / (p00 + x * p10))
            ahead[t] = np.clip(ahead[t] + own[t], -30, 30)
        for t in range(CHAIN - 2, -1, -1):
            y = np.exp(np.clip(own[t + 1] + back[t + 1], -30, 30))
            back[t] = np.where(chains.there[t + 1], np.log((p10 + p11 * y) / (p00 + p01 * y)), 0)
        odds = (ahead + back)[chains.step, chains.chain]
        return odds, ahead[:-1], np.clip(own[1:] + back[1:], -30, 30)

    def expected_moves(self, chains: Chains, ahead: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Expected numbers of the four transitions."""
        x, y = np.exp(ahead), np.exp(after)
        (p00, p01), (p10, p11) = np.exp(self.moves)
        moves = np.array([[p00 + 0 * x, p01 * y], [x * p10, x * p11 * y]])
        return np.where(chains.there[1:], moves / moves.sum(axis=(0, 1)), 0).sum(axis=(2, 3))

    def log_total(self, chains: Chains, odds: np.ndarray, ahead: np.ndarray) -> float:
        """Log of the summed potentials of all labellings of the chains."""
        p00, p10 = np.exp(self.moves[:, 0])
        steps = np.where(chains.there[1:], np.log(p00 + np.exp(ahead) * p10), 0).sum()
        last = np.append(chains.chain[1:] != chains.chain[:-1], True)  # there nothing comes back
        return float(steps + np.logaddexp(0, odds[last]).sum())

    def tag(self, chains: Chains) -> np.ndarray:
        """Marginal log odds of the tokens, in their order."""
        return self.log_odds(chains, chains.tokens)[0]

    def evidence(self, total: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log of the summed odds beyond what clean texts of these lengths have, at least 0."""
        mean, variance = self.clean
        granted = mean * lengths + DEVIATIONS * np.sqrt(variance * lengths)
        return np.minimum(np.log1p(np.maximum(total - granted, 0)), ODDS)


def summed_odds(odds: np.ndarray, chains: Chains) -> np.ndarray:
    """Sum of the tokens' odds, for each text."""
    return np.bincount(chains.text, np.exp(np.minimum(odds, ODDS)), minlength=len(chains.lengths))


class _FeatureTexts:
    """Texts that have a feature: clean ones in the first half, then toxic ones; the
    last two cells count the texts."""

    def __init__(self):
        self.total = np.zeros(2 * CELLS + 2, np.int64)

    def __call__(self, batch: pa.RecordBatch) -> None:
        texts, labels = as_bytes(batch), batch.column("y").to_pylist()
        for part in runs_of(texts, RUN_BYTES):
            vocabulary = Vocabulary()
            words = [np.unique(vocabulary.of(t.translate(FOLDED).split())) for t in texts[part]]
            rows = np.array(vocabulary.rows, np.int64).reshape(-1, FEATURES)
            for own, y in zip(words, labels[part]):
                self.total[np.unique(rows[own]) + y * CELLS] += 1
                self.total[2 * CELLS + y] += 1


def _tokenised(sample: DataFrame, marks: np.ndarray) -> DataFrame:
    """The sample in runs of texts: numbers of their tokens, in order, with labels, and
    the feature cells of the numbers."""
    shared = Shared(sample.sparkSession, marks)

    def start():
        marks = shared.load()

        def work(batch: pa.RecordBatch) -> dict:
            texts, y = as_bytes(batch), batch.column("y").to_numpy(zero_copy_only=False)
            out = {"lengths": [], "tokens": [], "cells": [], "labels": []}
            for part in runs_of(texts, RUN_BYTES):
                vocabulary = Vocabulary()
                chains = Chains.of(texts[part], vocabulary)
                cells = np.array(vocabulary.rows, np.int64).reshape(-1, FEATURES)
                tokens = chains.tokens.astype(np.int64)
                marked = marks[cells].any(axis=1)[tokens]
                out["lengths"].append(chains.lengths)
                out["tokens"].append(tokens)
                out["cells"].append(cells.ravel())
                out["labels"].append(marked & (y[part] == 1)[chains.text])
            return out

        return work

    schema = "lengths array<long>, tokens array<int>, cells array<int>, labels array<boolean>"
    return row_pass(sample, schema, start)


class _Gradient:
    """Loss and expected minus observed features of the labelled tokens."""

    def __init__(self, field: Field):
        self.field = field
        self.loss, self.weights, self.moves = 0.0, np.zeros(CELLS + 1), np.zeros((2, 2))

    def __call__(self, batch: pa.RecordBatch) -> None:
        for row in zip(*(batch.column(c) for c in ("lengths", "tokens", "cells", "labels"))):
            if len(row[1]):
                self._add(*(x.values.to_numpy(zero_copy_only=False) for x in row))

    def _add(self, lengths: np.ndarray, tokens: np.ndarray, cells: np.ndarray, label: np.ndarray) -> None:
        chains, cells = Chains(lengths, tokens), cells.reshape(-1, FEATURES)
        evidence = self.field.weights[cells].sum(axis=1) + self.field.weights[-1]
        own = evidence[tokens]
        odds, ahead, after = self.field.log_odds(chains, own)
        self.loss += self.field.log_total(chains, odds, ahead) - own[label].sum()
        miss = np.bincount(tokens, 1 / (1 + np.exp(-odds)) - label, minlength=len(cells))
        self.weights[:-1] += np.bincount(cells.ravel(), np.repeat(miss, FEATURES), minlength=CELLS)
        self.weights[-1] += miss.sum()
        self.moves += self.field.expected_moves(chains, ahead, after)
        seen, pair = chains.spread(label).astype(bool), chains.there[1:]
        for a in (0, 1):
            for b in (0, 1):
                n = ((seen[:-1] == a) & (seen[1:] == b) & pair).sum()
                self.moves[a, b] -= n
                self.loss -= n * self.field.moves[a, b]

    def sums(self) -> dict:
        cells = np.flatnonzero(self.weights)
        return {
            "cell": np.concatenate([cells, CELLS + 1 + np.arange(5)]),
            "value": np.concatenate([self.weights[cells], self.moves.ravel(), [self.loss]]),
        }


def _minimum(slope_at: Callable, now: np.ndarray, small: float) -> np.ndarray:
    """Minimum of a convex function by L-BFGS: ``slope_at`` gives its value and gradient,
    which is at most ``small`` long at the end."""
    value, slope = slope_at(now)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    while np.linalg.norm(slope) > small:
        step, shares = -slope, []
        for s, g in reversed(past):
            shares.append(s @ step / (s @ g))
            step = step - shares[-1] * g
        # Without past steps, one of length 1.
        step = step * (past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / np.linalg.norm(slope))
        for (s, g), share in zip(past, reversed(shares)):
            step = step + s * (share - g @ step / (s @ g))
        width = 1.0
        while True:
            then = now + width * step
            value_then, slope_then = slope_at(then)
            if value_then <= value + 1e-4 * width * (slope @ step):
                break
            width /= 4
            if width < 1e-6:  # no descent beyond the rounding of the sums
                return now
        s, g = then - now, slope_then - slope
        if s @ g > 1e-10 * (g @ g):
            past = [*past, (s, g)][-MEMORY:]
        now, value, slope = then, value_then, slope_then
    return now


def _fit_field(runs: DataFrame) -> Field:
    """Weights of the least loss, on the distributed sums."""
    spark = runs.sparkSession

    def field_of(now: np.ndarray) -> Field:
        field = Field()
        field.weights, field.moves = now[: CELLS + 1], now[CELLS + 1 :].reshape(2, 2)
        return field

    def slope_at(now: np.ndarray) -> tuple[float, np.ndarray]:
        shared = Shared(spark, field_of(now))
        parts = row_pass(
            runs, "cell long, value double", lambda: _Gradient(shared.load()), _Gradient.sums
        )
        # Rounded, so that the order of the sums does not show.
        sums = parts.groupBy("cell").agg(F.round(F.sum("value"), 6).alias("value")).toArrow()
        shared.destroy()
        slope = np.zeros(CELLS + 6)
        slope[sums["cell"].to_numpy()] = sums["value"].to_numpy()
        return slope[-1] + RIDGE / 2 * (now @ now), slope[:-1] + RIDGE * now

    count = F.aggregate("labels", F.lit(0).cast("long"), lambda n, x: n + x.cast("long"))
    toxic, tokens = runs.agg(F.sum(count), F.sum(F.size("labels"))).first()
    now = np.zeros(CELLS + 5)
    now[CELLS] = np.log(((toxic or 0) + 1) / ((tokens or 0) - (toxic or 0) + 1))
    return field_of(_minimum(slope_at, now, SMALL * max(1, toxic or 0)))


def _logistic(x: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton's method."""
    z, theta = np.column_stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        slope = z.T @ (n * p - positive) + 0.05 * theta
        curve = (z * (n * p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return float(theta[0]), float(theta[1])


def _marks(clean: np.ndarray, n_clean: int, toxic: np.ndarray, n_toxic: int) -> np.ndarray:
    """Features that mark a token of a toxic text as toxic."""
    both, test = clean + toxic, 0.0
    for seen, n in ((clean, n_clean), (toxic, n_toxic)):
        expected = np.maximum(both, 1) * (n / (n_clean + n_toxic))
        test = test + 2 * seen * np.log(np.maximum(seen, 1) / expected)
    shares = toxic / n_toxic, clean / n_clean
    return (test >= MARK_TEST) & (shares[0] >= MARK_SHARE * (shares[0] + shares[1])) & (toxic > 0)


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> Field:
    sample = scratch.keep(
        labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, FIT_ROWS), "sample"
    )
    texts = counted(sample, 2 * CELLS + 2, _FeatureTexts)
    n_clean, n_toxic = texts[-2:]
    if not n_toxic or not n_clean:
        scratch.drop("sample")
        return Field()
    marks = _marks(texts[:CELLS], n_clean, texts[CELLS : 2 * CELLS], n_toxic)
    runs = scratch.keep(_tokenised(sample, marks), "runs")
    field = _fit_field(runs)
    scratch.drop("runs")
    shared = Shared(docs.sparkSession, field)

    def start():
        field = shared.load()
        evidence = Evidence(field)

        def work(batch: pa.RecordBatch) -> dict:
            texts, total, lengths = as_bytes(batch), [], []
            for part in runs_of(texts, RUN_BYTES):
                chains = Chains.of(texts[part], evidence)
                total += summed_odds(field.tag(chains), chains).tolist()
                lengths += chains.lengths.tolist()
            return {"total": total, "n": lengths}

        return work

    sums = scratch.keep(row_pass(sample, "total double, n long, y int", start), "sums")
    field.clean = _clean_odds(sums)
    clean = field.clean

    def count():
        field = Field()
        field.clean = clean

        def work(batch: pa.RecordBatch) -> dict:
            total, n = (batch.column(c).to_numpy() for c in ("total", "n"))
            return {"step": np.round(field.evidence(total, n) * ODDS_STEPS).astype(np.int64)}

        return work

    steps = row_pass(sums, "step long, y int", count).groupBy("step")
    steps = steps.agg(F.count("y").alias("n"), F.sum("y").alias("toxic")).orderBy("step")
    at, n, toxic = (np.array(c, float) for c in zip(*steps.collect()))
    field.curve = _logistic(at / ODDS_STEPS, n, toxic)
    scratch.drop("sample", "sums")
    return field


def _clean_odds(sums: DataFrame) -> tuple[float, float]:
    """Mean odds of a token of clean texts and their variance by token, which counts that
    odd tokens come together in texts. One token of even odds that was not seen is added."""
    n, total = F.col("n").cast("double"), F.col("total")
    parts = (n, total, n * n, n * total, total * total)
    clean = sums.where("y = 0").agg(*(F.sum(p) for p in parts)).first()
    # Rounded, so that the order of the sums does not show.
    n, total, nn, nt, tt = (float(f"{x or 0:.9g}") for x in clean)
    mean = (total + 1) / max(n, 1)
    return mean, (max(tt - 2 * mean * nt + mean * mean * nn, 0) + 1) / max(n, 1)


def _spans(text: bytes, toxic: np.ndarray) -> list[tuple[int, int]]:
    """Code point offsets of the runs of toxic tokens."""
    places = [m.span() for m in _TOKEN.finditer(text.translate(FOLDED))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], toxic.astype(np.int8), [0]])))
    runs = [(places[a][0], places[b - 1][1]) for a, b in edges.reshape(-1, 2)]
    return [(len(text[:a].decode()), len(text[:b].decode())) for a, b in runs]


def tag(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` of every row."""
    shared = Shared(docs.sparkSession, field)

    def start():
        field = shared.load()
        evidence, (slope, offset) = Evidence(field), field.curve

        def work(batch: pa.RecordBatch) -> dict:
            texts, scores, spans = as_bytes(batch), [], []
            for part in runs_of(texts, RUN_BYTES):
                own = texts[part]
                chains = Chains.of(own, evidence)
                odds = field.tag(chains)
                seen = field.evidence(summed_odds(odds, chains), chains.lengths)
                level = np.clip(slope * seen + offset, -50, 50)
                scores.append(1 / (1 + np.exp(-level)))
                toxic = np.split(odds > 0, np.cumsum(chains.lengths)[:-1])
                spans += [
                    [{"begin": a, "end": b} for a, b in _spans(t, m)] if m.any() else []
                    for t, m in zip(own, toxic)
                ]
            scores = np.concatenate(scores)
            return {
                "score": scores,
                "predicted": (scores >= THRESHOLD).astype(np.int32),
                "spans": spans,
            }

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "text",
    )
    schema = (
        "doc_id long, held_out boolean, score double, predicted int, "
        "spans array<struct<begin:int,end:int>>"
    )
    return row_pass(rows, schema, start)
