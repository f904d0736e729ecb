"""The pipeline's stages, each against what its input says, and the whole against their plain chain."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from tests.llm.test_near_dedup import brute
from tidemark.llm import mixing, pieces
from tidemark.llm.common import stored, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def chain(spark):
    docs, out = table(spark, SF_DIR, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), "chain")
        out.append(docs)
    return [table(spark, SF_DIR, "documents"), *out]


def test_columns_and_order(chain):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language identification", "exact dedup", "near dedup", "source mixing", "pieces"]
    for frame in chain[:-1]:
        assert frame.columns == chain[0].columns


def test_stages_against_plain_versions(chain):
    rows = [frame.collect() for frame in chain]
    assert {r.doc_id for r in rows[1]} == {r.doc_id for r in rows[0] if r.text and any(c.isalpha() for c in r.text)}
    last = {}
    for r in rows[1]:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert {r.doc_id for r in rows[2]} == set(last.values())
    kept = {r[0] for r in brute([(r.doc_id, r.text) for r in rows[2]], percent=80) if r[3]}
    assert sorted(r.doc_id for r in rows[3]) == sorted(kept)
    taken = {r.id: (r.taken, r.size) for r in mixing.taken_words(mixing.mix(chain[3])).collect()}
    times = {}
    for r in rows[4]:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    for i, (words, size) in taken.items():
        assert words // size <= times.get(i, 0) <= -(-words // size)
    library = sentencepiece.SentencePieceProcessor(model_proto=pieces.public_model())
    assert len(rows[5]) == len(rows[4])
    text = {r.doc_id: r.text for r in rows[4]}
    for r in rows[5]:
        ids = [1, *library.encode(text[r.doc_id]), 2]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_run_is_the_chain(spark, chain):
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert got == sorted(map(tuple, chain[-1].collect()))


def test_stages_take_odd_documents(spark, edge_docs, no_docs):
    for docs in (edge_docs.select("doc_id", "text", "lang", "source", "n_chars"), no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF_DIR), "odd")
        assert docs.columns[0] == "doc_id"
