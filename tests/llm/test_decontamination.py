"""Windows found in texts against a search of every window at every place."""

import random

import pytest

from skyledger.llm import decontamination

WORDS = ["a", "b", "c", "Dé", "7"]


def brute(text, items):
    words = decontamination.item_words(None if text is None else text.encode())
    hit, found = set(), set()
    for item, item_text in items:
        theirs = decontamination.item_words(None if item_text is None else item_text.encode())
        windows = {tuple(theirs[i : i + 13]) for i in range(max(1, len(theirs) - 12))} if theirs else set()
        for window in windows:
            for p in range(len(words) - len(window) + 1):
                if tuple(words[p : p + len(window)]) == window:
                    hit |= set(range(p, p + len(window)))
                    found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(words)


def tables(seed):
    draw = random.Random(seed)

    def prose(n, k):
        return draw.choice([" ", ", ", "\n"]).join(draw.choices(WORDS[:k], k=n))

    items = [(i, prose(draw.choice([1, 2, 3, 5, 12, 13, 14, 30]), draw.choice([2, 5]))) for i in range(12)]
    items += [(3, items[5][1].upper()), (None, items[0][1]), (98, None), (99, " .,")]
    texts = [prose(draw.choice([0, 1, 2, 3, 13, 40, 200]), draw.choice([1, 2, 5])) for _ in range(30)]
    texts += [f"{prose(20, 5)} {items[i][1]} {prose(9, 5)}" for i in range(12)]
    texts += [None, "", texts[-1], texts[-1], "x " * 3000 + items[7][1]]
    return list(enumerate(texts)), items


@pytest.mark.parametrize("salt_rows, filter_bits", [(100_000, 1 << 23), (2, 8), (50, 1 << 10)])
def test_every_window_is_found(spark, monkeypatch, salt_rows, filter_bits):
    """With few bits nearly every place asks; with few rows a salt, prefixes are dealt."""
    monkeypatch.setattr(decontamination, "SALT_ROWS", salt_rows)
    monkeypatch.setattr(decontamination, "FILTER_BITS", filter_bits)
    monkeypatch.setattr(decontamination, "ROWS_AT_ONCE", 7)
    docs, items = tables(salt_rows)
    frames = (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    rows = decontamination.benchmark_hits(*frames).collect()
    found = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows}
    assert len(rows) == len(docs)
    assert found == {doc: brute(text, items) for doc, text in docs}
    kept = {r.doc_id for r in decontamination.decontaminate(*frames).collect()}
    assert kept == {doc for doc, result in found.items() if not result[3]}


def test_columns_of_other_names_clash_with_nothing(spark):
    docs = spark.createDataFrame(
        [(1, "one two three", 5, "k"), (2, "four", 6, None), (None, None, 7, "z")],
        "doc_id long, text string, key int, text_key string",
    )
    items = spark.createDataFrame([(1, "One Two", "x", 3)], "item_id long, text string, words string, salts int")
    kept = decontamination.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.key for r in kept.collect()) == [6, 7]
    hits = {r.doc_id: r for r in decontamination.benchmark_hits(docs, items).collect()}
    assert hits[1].n_hit == 2 and hits[1]["items"] == ["1"] and hits[None].n_words == 0
