"""Quality classifier: kernel ridge on random Fourier features, calibrated.

Every text is reduced to a few statistics. Random Fourier features approximate a
Gaussian kernel over them; the normal equations of a ridge regression on the label
are summed by partition and solved; isotonic regression maps the fitted values to
the share of good texts, which is the score.

It is fitted on at most ``FIT_ROWS`` labelled ids outside the held-out fold; every
text is scored. Ids, languages and sources are not inputs.

Null and empty texts have statistics like any other and get a score. Without
labelled rows every score is 0.5. Repeated rows count as often as they occur. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import (
    Scratch,
    Shared,
    WordHashes,
    as_bytes,
    covered,
    fold,
    labelled_sample,
    ngrams,
    repeated,
    row_pass,
)

#: Most labelled ids the model is fitted on.
FIT_ROWS = 30_000
FOLDS, HELD_OUT = 5, 0
#: Random features, width of the kernel in standard deviations, ridge per row.
FEATURES, WIDTH, RIDGE = 192, 2.5, 1e-4
THRESHOLD = 0.3
#: Partitions whose sums are added up, and steps of the fitted value.
SUMS, STEPS = 32, 500

_CLASSES = [
    bytes(range(0x41, 0x5B)),  # capitals
    bytes(range(0x30, 0x3A)),  # digits
    b"#*$%&<>",
    b"|",
    b"!?",
    b".,;:",
    b"\n",
    b" \t\r\x0b\x0c",
    bytes(range(0x80, 0x100)),
]
N_STATISTICS = len(_CLASSES) + 8


def statistics(text: bytes | None, hashes: WordHashes) -> list[float]:
    text = text or b""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    shares = [1 - len(text.translate(None, c)) / size if text else 0.0 for c in _CLASSES]
    lines = [line for line in text.split(b"\n") if line.strip()]
    keys = hashes.of(words)
    again = np.zeros(0, np.int64)
    if len(words) > 8:
        again = np.flatnonzero(repeated(ngrams(keys, 8)))
    return [
        *shares,
        np.log1p(len(words)),
        np.log1p(size / n),
        len(np.unique(keys)) / n,
        len(set(lines)) / max(1, len(lines)),
        covered(again, 8, len(words)).mean() if len(again) else 0.0,
        np.log1p(len(words) / max(1, len(lines))),
        sum(map(bytes.isupper, words)) / n,
        sum(map(bytes.isalpha, words)) / n,
    ]


class Model:
    """Statistics to raw value; ``curve`` maps that to a score."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        random = np.random.default_rng(8)
        self.mean, self.deviation = mean, deviation
        self.directions = random.normal(0, 1 / WIDTH, (N_STATISTICS, FEATURES))
        self.phases = random.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.curve = np.array([0.0]), np.array([0.5])

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        z = np.clip((stats - self.mean) / self.deviation, -6, 6)
        waves = np.sqrt(2 / FEATURES) * np.cos(z @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), *self.curve), 0.0, 1.0)


def isotonic(at: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pools adjacent violators; places and values of the pooled blocks."""
    blocks: list[list[float]] = []
    for x, count, y in zip(at, n, positive):
        blocks.append([x * count, count, y])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    x, count, y = np.array(blocks).T
    return x / count, y / count


def _stats_of(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, N_STATISTICS)


class _NormalEquations:
    def __init__(self, model: Model):
        self.model = model
        self.total = np.zeros((FEATURES + 1, FEATURES + 2))

    def __call__(self, batch: pa.RecordBatch) -> None:
        z = self.model.features(_stats_of(batch))
        self.total += z.T @ np.column_stack([z, batch.column("y").to_numpy(zero_copy_only=False)])


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> Model:
    def start():
        hashes = WordHashes()
        return lambda batch: {"stats": [statistics(t, hashes) for t in as_bytes(batch)]}

    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, FIT_ROWS)
    sample = scratch.keep(row_pass(sample, "stats array<double>, y int", start), "sample")
    each = [F.col("stats")[i] for i in range(N_STATISTICS)]
    moments = sample.agg(*(F.avg(c) for c in each), *(F.stddev_pop(c) for c in each)).first()
    if moments[0] is None:
        return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS))
    mean, deviation = np.array(moments).reshape(2, -1)
    model = Model(mean, np.where(deviation > 1e-9, deviation, 1.0))
    spark = docs.sparkSession
    shared = Shared(spark, model)
    sums = row_pass(
        sample.coalesce(SUMS),
        "total array<double>",
        lambda: _NormalEquations(shared.load()),
        lambda work: {"total": [work.total.ravel()]},
    )
    total = sum(np.array(r["total"]) for r in sums.collect()).reshape(FEATURES + 1, FEATURES + 2)
    gram, target = total[:, :-1], total[:, -1]
    rows = gram[-1, -1]
    model.weights = np.linalg.solve(gram + RIDGE * rows * np.eye(FEATURES + 1), target)
    fitted = Shared(spark, model)

    def start_steps():
        model = fitted.load()
        return lambda batch: {
            "step": np.clip(np.round(model.raw(_stats_of(batch)) * STEPS), -STEPS, 2 * STEPS).astype(np.int64)
        }

    steps = row_pass(sample, "step long, y int", start_steps)
    # At most one row per step reaches the driver.
    steps = steps.groupBy("step").agg(F.count("y").alias("n"), F.sum("y").alias("good")).orderBy("step")
    at, n, good = (np.array(c, float) for c in zip(*steps.collect()))
    model.curve = isotonic(at / STEPS, n, good)
    scratch.drop("sample")
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    shared = Shared(docs.sparkSession, model)

    def start():
        model, hashes = shared.load(), WordHashes()

        def work(batch: pa.RecordBatch) -> dict:
            scores = model.score(np.array([statistics(t, hashes) for t in as_bytes(batch)]))
            return {"score": scores, "predicted": (scores >= THRESHOLD).astype(np.int32)}

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "text",
    )
    return row_pass(rows, "doc_id long, held_out boolean, score double, predicted int", start)
