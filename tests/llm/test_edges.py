"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing
column names, for every operator and every stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import (
    chat_format,
    decontamination,
    language_id,
    mixing,
    near_dedup,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    toxicity,
)
from tests.llm.conftest import EDGES, LONG, PROSE


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, PROSE.upper()), (1, PROSE.upper()), (2, "one"), (3, None), (4, ""), (None, "zwölf Äpfel")]
    return spark.createDataFrame(items, "item_id long, text string")


def run(name, docs, labels, benchmark, scratch):
    if name == "shard":
        return sharding.shard_documents(docs, 3, scratch)
    if name == "toxic":
        return toxicity.tag(docs, toxicity.fit(docs, labels, scratch))
    if name == "near":
        return near_dedup.near_duplicates(docs, scratch)
    if name == "passages":
        return substring_dedup.remove_repeated(docs, scratch)
    if name == "rules":
        return quality_rules.judge(docs, quality_rules.fit(docs, labels))
    if name == "language":
        return language_id.identify(docs, language_id.fit(docs))
    if name == "quality":
        return quality_classifier.score(docs, quality_classifier.fit(docs, labels, scratch))
    if name == "benchmark":
        return decontamination.benchmark_hits(docs, benchmark)
    return mixing.mix(docs, scratch)


OPERATORS = ["shard", "toxic", "near", "passages", "rules", "language", "quality", "benchmark", "mix"]


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_one_result(name, edges, labels, benchmark, scratch):
    rows = run(name, edges, labels, benchmark, scratch).collect()
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in rows)
    assert ids == sorted((d[0] is None, d[0] or 0) for d in EDGES)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, nothing, labels, benchmark, scratch):
    assert run(name, nothing, labels, benchmark, scratch).collect() == []


def test_without_labels_or_items(edges, labels, benchmark, scratch):
    none = labels.limit(0)
    tagged = run("toxic", edges, none, benchmark, scratch).collect()
    assert {r.predicted for r in tagged} == {0}
    assert {r.score for r in run("quality", edges, none, benchmark, scratch).collect()} == {0.5}
    assert all(r.kept != r.base_failed for r in run("rules", edges, none, benchmark, scratch).collect())
    hits = run("benchmark", edges, labels, benchmark.limit(0), scratch).collect()
    assert {r.n_hit for r in hits} == {0}


def test_defined_results(edges, labels, benchmark, scratch):
    near = run("near", edges, labels, benchmark, scratch).collect()
    classes = [(r.doc_id, r.class_id, r.class_size) for r in near]
    assert classes.count((1, 1, 4)) == 2 and (2, 1, 4) in classes and (None, 1, 4) in classes
    assert (3, 3, 1) in classes and (4, 4, 2) in classes and (5, 4, 2) in classes
    passages = {r.doc_id: r for r in run("passages", edges, labels, benchmark, scratch).collect()}
    assert (passages[1].n_words, passages[1].n_removed) == (60, 60)
    assert (passages[2].n_words, passages[2].n_removed) == (61, 60)
    assert passages[7].n_removed == 0 and passages[7].n_words == len(LONG.split())
    assert passages[8].n_removed == 80
    found = {r.doc_id: r for r in run("language", edges, labels, benchmark, scratch).collect()}
    assert found[3].lang_pred == found[4].lang_pred == "und" and found[7].lang_pred == "en"
    hits = {r.doc_id: r for r in run("benchmark", edges, labels, benchmark, scratch).collect()}
    assert hits[1].n_hit == 60 and hits[1]["items"] == ["1"] and hits[9]["items"] == ["2"]
    # Only A-Z is lowered, so the umlaut's case counts; an item without an id is "".
    assert hits[8]["items"] == [""] and hits[8].n_hit == hits[8].n_words == 80
    mix = run("mix", edges, labels, benchmark, scratch).collect()
    assert all(r.taken <= 3 * r.size and r.taken >= 0 for r in mix)


def test_turns(spark):
    part = {"kind": "text", "text": "a", "ref": None, "width": None, "height": None, "seconds": None, "pages": None}
    image = part | {"kind": "image", "ref": "s3://x", "width": 600, "height": 10}
    odd = part | {"kind": "video", "ref": "r"}
    rows = [
        (1, 0, "user", [part, image, odd, None, part]),
        (1, 1, "assistant", [part | {"text": "&lt;|[<"}]),
        (1, 1, "assistant", [part | {"text": "&lt;|[<"}]),
        (1, None, None, None),
        (None, 0, "a|b", []),
        (2, 0, "assistant", [part | {"text": None}]),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_format.PART}>")
    formatted = chat_format.format_turns(turns)
    pieces = {(r.conv_id, r.seq): r for r in formatted.collect()}
    assert len(pieces) == 6 and pieces[(1, 0)].turn is None
    first = pieces[(1, 1)]
    assert first.piece == "<|user|>\na<image:1><video:2>a<|end|>\n" and first.tokens == 2 + 2 * 85
    assert [(a.number, a.kind, a.ref) for a in first.attachments] == [(1, "image", "s3://x"), (2, "video", "r")]
    read = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    assert read[1].loss_chars == 14 and read[2].loss_chars == 0 and read[None].n_turns == 1
    assert chat_format.read_back(chat_format.format_turns(turns.limit(0))).collect() == []


@pytest.fixture
def folder(spark, labels, benchmark, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, name, stage, edges, nothing, folder):
    kept = stage(spark, edges, folder)
    assert kept.columns[: len(edges.columns)] == edges.columns
    rows = kept.collect()
    if name == "sharding":
        assert len(rows) == len(EDGES) and kept.columns[-1] == "shard_"
    elif name == "near_dedup":
        assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 3, 4, 6, 7, 8, 9, 10]
    elif name == "decontamination":
        assert sorted((r.doc_id or 0) for r in rows) == [0, 3, 4, 5, 6, 7, 10]
    elif name == "quality_rules":
        assert {r.doc_id for r in rows} <= {1, 2, None, 7}
    assert stage(spark, nothing, folder).where(F.lit(True)).collect() == []
