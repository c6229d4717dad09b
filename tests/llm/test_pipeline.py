"""The pipeline against its stages done by brute force, and on edge cases."""

import itertools

import numpy as np
import pytest

import corpus_pipeline
from lensgrove.llm import langid, mixing, packing, simhash

from .test_operators import COLUMNS, EDGE, close, groups

FOLDER = "/root/testdata/sf0.001"


def test_stages_are_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix", "pack"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.collect()
    model = langid.train(docs)
    found = langid.label_texts([r["text"] for r in rows], model)
    kept = [r for r, (spans, lang, share, level) in zip(rows, found) if lang is not None and level >= model.floor]
    first = {}
    for r in sorted(kept, key=lambda r: r["doc_id"]):
        first.setdefault(r["text"], r)
    kept = list(first.values())
    fps = simhash.simhash([r["text"] for r in kept])
    pairs = {
        (i, j)
        for i, j in itertools.combinations(range(len(kept)), 2)
        if fps[i] and fps[j] and close(fps[i], fps[j], simhash.BUDGET)
    }
    label = groups(pairs, len(kept))  # rows are in the order of doc_id, so the least index is the least id
    kept = [r for k, r in enumerate(kept) if label[k] == k]
    stage = docs.where(docs.doc_id.isin([r["doc_id"] for r in kept]))
    mixed = mixing.mix(stage)  # held against brute force in test_operators.py
    want = sorted(map(tuple, packing.harmonic_pack(mixed).collect()))
    got = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect()))
    assert got == want
    assert len(kept) < len(rows) and np.mean([g[5] for g in got]) > 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_edges(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.createDataFrame(EDGE, COLUMNS)
    out = stage(spark, docs, FOLDER)
    assert name == "pack" or out.columns == docs.columns
    assert out.count() > 0
    assert stage(spark, docs.limit(0), FOLDER).count() == 0
