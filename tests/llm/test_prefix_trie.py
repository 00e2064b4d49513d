"""The trie against brute force: shared turns, ties, long and copied conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm import prefix_trie
from skyledger.llm.common import Scratch

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth string, part string"


def digest(role, text):
    inner = hashlib.md5(role.encode()).hexdigest() + hashlib.md5(text.encode()).hexdigest()
    return hashlib.md5(inner.encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    for turns in own.values():
        turns.sort()
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c / 5) * 5
        built[c] = [t[3:] for t in own.get(c - base, [])[:h] + turns[h:]]
    nodes = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for seq in nodes:
        if seq:
            children[seq[:-1]].append(seq)
    leaves, saved = {}, {}
    for seq in sorted(nodes, key=len, reverse=True):
        below = children[seq]
        own_saved = (len(nodes[seq]) - 1) * len(seq[-1][1].encode()) if seq else 0
        leaves[seq] = sum(leaves[b] for b in below) if below else 1
        saved[seq] = own_saved + sum(saved[b] for b in below)
    out = set()
    for seq, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(seq))
        parent = min(nodes[seq[:-1]]) if seq else None
        out.add((min(members), len(seq), parent, len(members), len(children[seq]), leaves[seq], saved[seq],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def table(seed, convs, most, words):
    rng = random.Random(seed)
    rows = []
    for c in range(-convs // 4, convs):
        for t in range(rng.randint(0, most)):
            rows.append((c, t, rng.choice("ua"), rng.choice(words)))
    return rows


CASES = {
    "mixed": table(1, 80, 14, ["x", "yy", "zwölf"]),
    "nested": [(c, t, "u", "same") for c in range(60) for t in range(8 + c // 2)],
    "copies": [(c, t, "u", f"t{t}") for c in range(50) for t in range(30)] + [(7, 40, "u", "end")],
    "one": [(5, t, "u", f"t{t % 7}") for t in range(400)] + [(6, t, "u", f"t{t % 7}") for t in range(395)],
    "ties": [(1, 0, "u", "b"), (1, 0, "u", "a"), (1, 0, "u", "a"), (1, None, None, None), (1, None, "", ""),
             (None, 0, "u", "lost"), (2, None, "u", "b"), (3, 9, "u", "é" * 5000), (-3, 1, "a", "c")],
}


@pytest.mark.parametrize("chunk", [3, 4096])
@pytest.mark.parametrize("name", list(CASES))
def test_against_brute_force(spark, conf, monkeypatch, name, chunk):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    rows = [(*r, "1", "2", "3") for r in CASES[name]]
    random.Random(3).shuffle(rows)
    made = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "t"))
    found = [tuple(r) for r in made.collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows)


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA), Scratch(spark, "t")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 900), st.integers(0, 10_000))
def test_findclose(n, seed):
    rng, depth, bits = random.Random(seed), 0, []
    opened = 0
    while opened < n or depth:
        up = opened < n and (depth == 0 or rng.random() < rng.choice([0.3, 0.5, 0.9]))
        bits.append(up)
        opened, depth = opened + up, depth + (1 if up else -1)
    stack, close = [], {}
    for i, up in enumerate(bits):
        if up:
            stack.append(i)
        else:
            close[stack.pop()] = i
    forest = prefix_trie.Parentheses(np.array(bits))
    assert {p: forest.findclose(p) for p in close} == close
