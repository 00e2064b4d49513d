"""Operators against brute force on small tables, reference SQL, held-out rows."""

from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import near_dedup, quality_rules, sharding, substring_dedup
from skyledger.llm.common import Scratch, WordHashes
from skyledger.llm.oracles import ORACLES
from skyledger.llm.queries import QUERIES
from tests.llm.conftest import MIDDLE, SMALL, supplied
from tests.oracle import connect, differences

pytestmark = [supplied(SMALL), supplied(MIDDLE)]


@pytest.mark.parametrize("name", list(ORACLES))
def test_reference_sql(spark, name):
    assert differences(spark, connect(SMALL), SMALL, name) == []


def best_fit(sizes, capacity):
    """Shards of groups of these decreasing sizes, one group after the other."""
    free, shards = [], []
    for size in sizes:
        fits = [(f, s) for s, f in enumerate(free) if f >= size]
        shard = min(fits)[1] if fits else len(free)
        if not fits:
            free.append(max(capacity, size))
        free[shard] -= size
        shards.append(shard)
    return shards


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 60))
def test_best_fit(sizes, capacity):
    runs = sharding.pack_counts(list(Counter(sizes).items()), capacity)
    shards = [shard for _, _, n, shard in runs for _ in range(n)]
    assert shards == best_fit(sorted(sizes, reverse=True), capacity)


def test_shards(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sizes = Counter()
    for d in docs.collect():
        sizes[d.text] += len((d.text or "").encode()) + 1
    for fine in (256, 2):  # with the second, nearly all groups are numbered within their size
        monkeypatch.setattr(sharding, "FINE", fine)
        rows = sharding.shard_documents(docs, 4, Scratch(spark, "t")).collect()
        by_text, slots, filled = defaultdict(set), defaultdict(list), Counter()
        texts = {r.doc_id: r.text for r in docs.collect()}
        for r in rows:
            by_text[texts[r.doc_id]].add(r.shard)
            slots[r.shard].append(r.slot)
            filled[r.shard] += r.size
        assert len(rows) == len(texts) and all(len(s) == 1 for s in by_text.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert len(filled) == 4 and max(filled.values()) < 1.01 * min(filled.values())
        # Every group is packed: the shards hold what naive packing at this capacity puts there.
        ordered = sorted(sizes.values(), reverse=True)
        mean = -(-sum(ordered) // 4)
        naive = [
            sorted(Counter(dict(enumerate(np.bincount(best_fit(ordered, c), ordered).astype(int)))).values())
            for c in range(max(filled.values()), max(filled.values()) + mean // 2_000)
        ]
        assert sorted(filled.values()) in naive


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=35, max_size=70), min_size=1, max_size=12), st.data())
def test_index_finds_repeated_windows(texts, data):
    texts = sorted({" ".join(t) for t in texts} | {" ".join(texts[0][5:] + list("abcabcabc"))})
    weights = data.draw(st.lists(st.integers(1, 2), min_size=len(texts), max_size=len(texts)))
    w, counts = substring_dedup.WINDOW, Counter()
    split = [t.split() for t in texts]
    for words, n in zip(split, weights):
        for i in range(len(words) - w + 1):
            counts[tuple(words[i : i + w])] += n
    found = substring_dedup.repeated_in([t.encode() for t in texts], weights)
    for words, spans in zip(split, found):
        want = {i for i in range(len(words) - w + 1) if counts[tuple(words[i : i + w])] > 1}
        assert {i for a, b in spans for i in range(a, b - w + 1)} == want


def test_passages_in_many_contexts(spark, monkeypatch):
    """The path that cuts the segments of a hot anchor into windows."""
    monkeypatch.setattr(substring_dedup, "HOT_SEGMENTS", 1)
    assert differences(spark, connect(SMALL), SMALL, "op4_repeated_passages") == []


def classes_by_all_pairs(spark, docs):
    weights = near_dedup.Weights(near_dedup.inverse_frequency(docs))
    rows = [(r.text, r.doc_id) for r in docs.where("text IS NOT NULL").collect()]
    texts = sorted({t for t, _ in rows})
    sets, root = [weights.of(t.encode()) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if near_dedup.weighted_jaccard(sets[i], sets[j]) >= near_dedup.SIMILARITY:
                root[find(i)] = find(j)
    number = {t: find(i) for i, t in enumerate(texts)}
    least = {}
    for t, d in rows:
        least[number[t]] = min(d, least.get(number[t], d))
    return {d: least[number[t]] for t, d in rows}


@pytest.mark.parametrize("held", [64, 2])
def test_near_duplicates(spark, monkeypatch, held):
    """Against all pairs, on supplied texts and a group whose copies drift apart."""
    monkeypatch.setattr(near_dedup, "HELD", held)
    monkeypatch.setattr(near_dedup, "STREAMED", held)
    monkeypatch.setattr(near_dedup, "CHUNK", held)
    random = np.random.default_rng(1)
    base = [f"v{i}" for i in range(120)]
    drift = []
    for i in range(60):
        words = list(drift[random.integers(len(drift))].split() if drift else base)
        for at in random.integers(0, 120, 2):
            words[at] = f"x{i}"
        drift.append(" ".join(words))
    more = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(drift)], "doc_id long, text string")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(more)
    got = near_dedup.near_duplicates(docs, Scratch(spark, "t")).collect()
    assert {r.doc_id: r.class_id for r in got} == classes_by_all_pairs(spark, docs)


def test_weighted_samples_estimate_similarity():
    sampler = near_dedup.WeightedSampler(np.ones(near_dedup.DF_CELLS, np.float32))
    words = [f"a{i}" for i in range(300)]
    a, b = " ".join(words).encode(), " ".join(words[:280] + [f"b{i}" for i in range(20)]).encode()
    same = (sampler.bands(a) == sampler.bands(b)).mean()
    truth = near_dedup.weighted_jaccard(sampler.of(a), sampler.of(b))
    assert 0.8 < truth < 0.95 and abs(same - truth**near_dedup.ROWS) < 0.35


def test_base_counts(spark):
    hashes = WordHashes()
    for (text,) in duckdb.connect().execute(f"SELECT text FROM '{SMALL}/documents.parquet'").fetchall():
        words, got = [w for w in text.replace("\n", " ").split(" ") if w], quality_rules.base_counts(text.encode(), hashes)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        counts, again = Counter(windows), set()
        for i, win in enumerate(windows):
            if counts[win] > 1:
                again.update(range(i, i + 8))
        lines, dup, seen = text.split("\n"), 0, set()
        for line in lines:
            if line.strip(" "):
                dup += line in seen
                seen.add(line)
        symbols = sum(text.count(c) for c in "#*$%&|<>")
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == (
            len(words), sum(map(len, words)), symbols, dup, len(again))


@pytest.mark.parametrize("name, label, least", [("op2_toxic_spans", "toxic", 0.93), ("op8_quality_score", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    scored = QUERIES[name](spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id")
    right = scored.where("held_out").agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]
    assert right >= least


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op6_language"](spark, MIDDLE).where("held_out").join(docs, "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


def test_quality_rules_separate_labels(spark):
    judged = QUERIES["op5_quality_rules"](spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id")
    judged = judged.where("NOT base_failed")
    kept = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()}
    assert kept[1] > 0.99 and kept[0] < 0.2


def test_pipeline(spark):
    """Every stage against its operator's own result on the rows before it."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality_rules.judge(docs, quality_rules.fit(docs, labels))
    good = {r.doc_id for r in judged.where("kept").collect()}
    kept = docs.where(F.col("doc_id").isin(*good))
    classes = classes_by_all_pairs(spark, kept)
    firsts = set(classes.values())
    con = connect(SMALL)
    dirty = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op9_decontamination']}) WHERE contaminated").fetchall()}
    ids = ", ".join(map(str, firsts - dirty))
    con.execute(f"CREATE VIEW left_over AS SELECT * FROM documents WHERE doc_id IN ({ids})")
    mix = ORACLES["op10_mix_sources"].replace("FROM documents", "FROM left_over")
    copies = {d: n for d, n in con.execute(f"SELECT doc_id, CAST(taken / size AS INT) FROM ({mix})").fetchall() if n}
    result = corpus_pipeline.run(spark, SMALL)
    assert result.columns == [*docs.columns, "shard"]
    rows = result.collect()
    assert Counter(r.doc_id for r in rows) == Counter(copies)
    assert {r.shard for r in rows} <= set(range(16))
    assert len({(r.text, r.shard) for r in rows}) == len({r.text for r in rows})
