"""The field of toxic spans: fit and evidence of long texts."""

import numpy as np
import pytest

from skyledger.llm import toxicity
from skyledger.llm.common import Scratch
from tests.llm.conftest import MIDDLE, supplied


@pytest.fixture(scope="module")
def field(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.fit(docs, labels, Scratch(spark, "t"))


@supplied(MIDDLE)
def test_long_clean_text(spark, field):
    """Length is no evidence, and does not hide a toxic phrase."""
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    clean = docs.join(labels.where("toxic = 0"), "doc_id").orderBy("doc_id").select("text").collect()
    words = [w for r in clean if r.text for w in r.text.split()]
    words = (words * (100_000 // len(words) + 1))[:110_000]
    half = len(words) // 2
    texts = [words, words[:half] + ["you", "idiot", "and", "moron"] + words[half:]]
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    scored = {r.doc_id: r for r in toxicity.tag(rows, field).collect()}
    assert [scored[i].predicted for i in (0, 1)] == [0, 1]
    assert scored[0].score < 0.2 and not scored[0].spans and scored[1].spans


def test_minimum():
    """Ends at a small gradient, however the coordinates are scaled."""
    scale, at = np.array([1e4, 1.0, 1e-2]), np.array([1.0, -2.0, 3.0])
    found = toxicity._minimum(lambda x: ((scale * (x - at) ** 2).sum(), 2 * scale * (x - at)), np.zeros(3), 1e-6)
    assert np.abs(found - at).max() < 1e-3
