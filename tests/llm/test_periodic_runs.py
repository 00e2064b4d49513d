"""Periodic runs against brute force over all periods."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm import periodic_runs
from skyledger.llm.queries import QUERIES
from tests.llm.conftest import EDGES, SMALL, supplied


def runs_of(words):
    """All (start, period, length): every stretch of equal words for every period, less
    those with a shorter period."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)] + [False]
        start = None
        for i, equal in enumerate(same):
            if equal and start is None:
                start = i
            elif not equal and start is not None:
                length, at, start = i - start + q, start, None
                part = words[at : at + length]
                shorter = any(part[d:] == part[:-d] for d in range(1, q))
                if length >= max(6, 4 * q) and not shorter:
                    found.append((at, q, length))
    return sorted(found)


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = runs_of(words)
    gone = {i for s, q, m in runs for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, q, m in runs)
    best = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else None
    first = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *first, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def found_in(spark, docs, scratch):
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return periodic_runs.periodic_runs(docs, scratch).select(*columns)


def stitch(pieces):
    runs = {}
    for q, a, b in sorted(pieces):
        last = runs.setdefault(q, [])
        if last and a <= last[-1][1]:
            last[-1][1] = max(last[-1][1], b)
        else:
            last.append([a, b])
    return sorted((a, q, b - a + q) for q, spans in runs.items() for a, b in spans)


blocks = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 9)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(blocks)
def test_pieces(parts):
    words = [w for block, times in parts for w in block * times]
    assert stitch(periodic_runs.pieces_of(np.array(words, np.uint64))) == runs_of(words)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=200))
def test_z_function(items):
    z = periodic_runs.z_function(items)
    for i in range(len(items)):
        k = 0
        while i + k < len(items) and items[k] == items[i + k]:
            k += 1
        assert z[i] == k


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r))


def test_edges(spark, edges, nothing, scratch):
    some = edges.where("doc_id is null or doc_id <> 7")
    rows = [tuple(r) for r in found_in(spark, some, scratch).collect()]
    assert order(rows) == order([expected(d[0], d[1]) for d in EDGES if d[0] != 7])
    assert found_in(spark, nothing, scratch).collect() == []


def test_very_long_texts(spark, scratch):
    same, cycle = "a " * 60_000, " ".join(f"w{i % 9_000}" for i in range(50_000))
    docs = spark.createDataFrame([(1, same), (2, cycle)], "doc_id long, text string")
    rows = {r.doc_id: r for r in found_in(spark, docs, scratch).collect()}
    assert tuple(rows[1])[1:6] == (1, 0, 60_000, 1, 60_000_000)
    assert tuple(rows[2])[1:6] == (1, 0, 50_000, 9_000, 5_555)


@supplied(SMALL)
def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    short = {d.doc_id: d.text for d in docs if len((d.text or "").split()) <= 600}
    rows = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()]
    assert len(rows) == len(docs) and sum(r[1] > 0 for r in rows) > 5
    assert order([r for r in rows if r[0] in short]) == order([expected(i, t) for i, t in short.items()])
