"""Codewords for any number of languages, decoding against all codewords."""

import time

import numpy as np
import pytest

from skyledger.llm import language_id


def test_codewords_of_any_number_of_languages():
    start = time.time()
    for n in range(1, 41):
        code = language_id.codewords(n)
        assert code.shape[0] == n and set(np.unique(code)) <= {-1, 1}
        assert len({row.tobytes() for row in code}) == n
        if n > 1:
            assert (abs(code.sum(axis=0)) < n).all()
            columns = {min(c.tobytes(), (-c).tobytes()) for c in code.T}
            assert len(columns) == code.shape[1]
    assert time.time() - start < 2


@pytest.mark.parametrize("n", [2, 4, 7, 8, 13])
def test_decoding_takes_the_codeword_with_the_least_loss(n):
    random = np.random.default_rng(n)
    model = language_id.Model([f"l{i:02}" for i in range(n)], random.integers(0, 50, (n, language_id.CELLS)))
    model.trust = random.random(model.code.shape)
    for text in ("some words", "other ones entirely", "a"):
        cells = language_id.gram_cells(text)
        margins = language_id.STEEP * model.margins(cells)
        losses = [
            sum(t * np.log1p(np.exp(-bit * m)) for t, bit, m in zip(trust, word, margins))
            for trust, word in zip(model.trust, model.code)
        ]
        assert model.predict(text)[0] == f"l{int(np.argmin(losses)):02}"


@pytest.mark.parametrize("n", [7, 8])
def test_seven_and_eight_languages(spark, n):
    rows = [(i * n + k, " ".join(f"{chr(97 + k)}{chr(98 + k)}{w}" for w in "xyz" * 3), f"l{k}") for i in range(12) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.identify(docs, language_id.fit(docs)).collect()
    wanted = {r[0]: r[2] for r in rows}
    assert all(r.lang_pred == wanted[r.doc_id] for r in found)


def test_junk_languages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 3)
    rows = [(i, "word " * (1 + i % 5), f"l{min(i % 4, i)}" if i < 200 else f"junk{i}") for i in range(260)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert len(model.languages) == 3 and all(x.startswith("l") for x in model.languages)
    assert language_id.identify(docs, model).count() == 260
