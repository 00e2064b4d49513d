"""Katz backoff against a direct computation with dictionaries."""

import functools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from skyledger.llm import katz
from skyledger.llm.queries import QUERIES
from tests.llm.conftest import EDGES, SMALL, supplied

END, BEGIN = object(), object()


def lowered(text):
    return (text or "").encode().lower().split() + [END]


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


class Brute:
    def __init__(self, docs, order):
        self.order = order
        self.counts = [Counter() for _ in range(order + 1)]
        for doc_id, text, *_ in docs:
            if not held_out(doc_id):
                words = [BEGIN] * (order - 1) + lowered(text)
                for i in range(order - 1, len(words)):
                    for k in range(1, order + 1):
                        self.counts[k][tuple(words[i - k + 1 : i + 1])] += 1
        self.total = sum(self.counts[1].values())
        self.factors = [None]
        for k in range(1, order + 1):
            n = Counter(self.counts[k].values())
            self.factors.append(katz.discounts([n[r] for r in range(1, katz.FEW + 2)]))
        self.after = [defaultdict(list) for _ in range(order + 1)]
        for k in range(2, order + 1):
            for gram in self.counts[k]:
                self.after[k][gram[:-1]].append(gram[-1])
        self.free = self.total - sum(self.cut(1, x) for x in self.counts[1].values())
        self.p = functools.cache(self._p)
        self.history = functools.cache(self._history)

    def cut(self, k, c):
        return c * (self.factors[k][c] if c <= katz.FEW else 1.0)

    def _history(self, history):
        """Size, freed share and its factor for unseen words."""
        k, seen = len(history) + 1, self.after[len(history) + 1].get(history)
        if not seen:
            return None
        total = sum(self.counts[k][(*history, w)] for w in seen)
        size, free = total, total - sum(self.cut(k, self.counts[k][(*history, w)]) for w in seen)
        if free <= 1e-9 * total:
            size, free = total + 1, 1
        return size, free / size / (1 - sum(self.p((*history[1:], w)) for w in seen))

    def _p(self, gram):
        k, c = len(gram), self.counts[len(gram)][gram]
        if k == 1:
            size = self.total if self.free > 1e-9 * self.total else self.total + 1
            return self.cut(1, c) / size if c else (size - self.total + self.free) / size
        known = self.history(gram[:-1])
        if not known:
            return self.p(gram[1:])
        return self.cut(k, c) / known[0] if c else known[1] * self.p(gram[1:])

    def score(self, text):
        words = [BEGIN] * (self.order - 1) + lowered(text)
        return sum(
            math.log10(self.p(tuple(words[i - self.order + 1 : i + 1])))
            for i in range(self.order - 1, len(words))
        )

    def row(self, doc_id, text):
        words = lowered(text)
        counts = [self.counts[1][(w,)] for w in words]
        base = sum(math.log10((c + 0.5) / (self.total + 0.5 * (len(self.counts[1]) + 1))) for c in counts)
        known = sum(c > 0 for c in counts)
        return (doc_id, held_out(doc_id), len(words), known, self.total, base, self.score(text))


def prose(seed, docs):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(docs):
        at, out = rng.randrange(60), []
        for _ in range(rng.randrange(40)):
            at = rng.choice([at + 1, at + 1, at + 2, rng.randrange(60)]) % 60
            out.append(words[min(at, rng.randrange(60))])
        texts.append((i, " ".join(out)))
    return texts


def same(rows, wanted):
    def key(r):
        return (r[0] is None, r[0] or 0, *r[1:5], round(r[5], 6), round(r[6], 6))

    rows, wanted = sorted(map(tuple, rows), key=key), sorted(wanted, key=key)
    assert [r[:5] for r in rows] == [w[:5] for w in wanted]
    assert np.allclose([r[5:] for r in rows], [w[5:] for w in wanted], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("order, chunk, bucket", [(1, 50, 64), (2, 70, 16), (3, 300, 100), (2, 1 << 20, 1 << 21)])
def test_against_brute_force(spark, scratch, monkeypatch, order, chunk, bucket):
    monkeypatch.setattr(katz, "CHUNK", chunk)
    monkeypatch.setattr(katz, "BUCKET", bucket)
    docs = prose(order, 150) + [(None, "w1 W2"), (3, "w1 w2 w3"), (3, "w1 w2 w3")]
    brute = Brute(docs, order)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    same(katz.score(frame, scratch, order).collect(), [brute.row(*d) for d in docs])


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_add_up(order):
    brute = Brute(prose(9, 200), order)
    vocabulary = [*(w for w, in brute.counts[1]), b"never seen"]
    histories = [*list(brute.after[order])[:40], (b"new",) * (order - 1)]
    for history in histories:
        assert math.isclose(sum(brute.p((*history, w)) for w in vocabulary), 1, rel_tol=1e-9)


def test_discounts():
    assert (katz.discounts([0] * 6) < 1).sum() == katz.FEW
    good = katz.discounts([1000, 300, 150, 90, 60, 43])
    assert (0 < good[1:]).all() and (good[1:] < 1).all() and (np.diff(good[1:]) > 0).all()


def test_edges(spark, edges, nothing, scratch):
    short = [(d[0], d[1]) for d in EDGES if d[0] != 7]
    brute = Brute(short, 2)
    same(katz.score(edges.where("doc_id is null or doc_id <> 7"), scratch).collect(), [brute.row(*d) for d in short])
    assert len(katz.score(edges, scratch).collect()) == len(EDGES)
    assert katz.score(nothing, scratch).collect() == []
    lonely = spark.createDataFrame([(i, "a b") for i in range(40) if held_out(i)], "doc_id long, text string")
    assert {r.score for r in katz.score(lonely, scratch).collect()} == {0.0}


@supplied(SMALL)
def test_query(spark):
    rows = QUERIES["op13_katz_score"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    brute = Brute([(d.doc_id, d.text) for d in docs], 2)
    same(rows, [brute.row(d.doc_id, d.text) for d in docs])
    test = [r for r in rows if r.held_out]
    assert test and sum(r.score for r in test) > sum(r.base_score for r in test)


@pytest.mark.parametrize("values", [[], [0, 0, 0], [1, 2, 255], [0, 256, 70_000], [2**63 + 5, 2**64 - 1, 7]])
def test_packing(values):
    values = np.array(values, np.uint64)
    assert katz.unpacked(katz.packed(values)).tolist() == values.tolist()
    ordered = np.sort(values)
    assert katz.unpacked_keys(katz.packed_keys(ordered)).tolist() == ordered.tolist()
    mixture = katz._unmixed(katz._mixed(values, values / 3, values / 7), 2)
    assert [m.tolist() for m in mixture] == [values.tolist(), (values / 3).tolist(), (values / 7).tolist()]
