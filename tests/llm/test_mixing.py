from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import block_texts, mix, mixed_documents, permuted, source_targets, taken_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared(sizes: dict, weights=(5, 2, 1)) -> dict:
    """Targets by sharing again and again what is over, as the rule is told."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = 3 * sizes[s]
        left -= sum(3 * sizes[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 3, None: 50}, {"a": 0, "b": 7}, {"x": 1}, {f"s{i}": i**3 for i in range(12)}])
def test_targets(spark, sizes):
    rows = source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    want = shared(sizes)
    assert {r.source for r in rows} == set(sizes)
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and r.target <= 3 * sizes[r.source] + 1e-9


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_is_one(spark, n):
    x = F.col("id")
    got = spark.range(n).select(permuted(x, F.lit(n).cast("long"), F.lit(1)).alias("p"), permuted(x, F.lit(n).cast("long"), F.lit(2)).alias("q")).collect()
    assert sorted(r.p for r in got) == sorted(r.q for r in got) == list(range(n))
    assert n < 10 or [r.p for r in got] != [r.q for r in got]


def corpus(spark):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(1 + i * 7 % 90)), ["a", "b", "c", None][i % 4]) for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_meets_targets_and_repeats_itself(spark):
    docs = corpus(spark)
    rows = taken_words(mix(docs, block_words=8)).collect()
    assert len(rows) == 300
    by = {}
    for r in rows:
        assert r.size == 1 + r.id * 7 % 90 and 0 <= r.taken <= 3 * r.size
        size, taken, target = by.get(r.source, (0, 0, r.target))
        by[r.source] = size + r.size, taken + r.taken, target
    want = shared({s: v[0] for s, v in by.items()})
    for s, (size, taken, target) in by.items():
        assert target == pytest.approx(want[s]) and abs(taken - target) <= 0.02 * target + 16
        assert all(r.source_size == size for r in rows if r.source == s)
    again = taken_words(mix(docs.repartition(7), block_words=8)).collect()
    assert sorted((r.id, r.taken) for r in again) == sorted((r.id, r.taken) for r in rows)


def test_blocks_hold_the_words_that_are_counted(spark):
    docs = corpus(spark).cache()
    mixed = mix(docs, block_words=8)
    words = {}
    for r in block_texts(docs, mixed, block_words=8).collect():
        assert 0 < len(r.text.split()) <= 8
        for w in r.text.split():
            words[int(w[1:].split("_")[0])] = words.get(int(w[1:].split("_")[0]), 0) + 1
    assert words == {r.id: r.taken for r in taken_words(mixed).collect() if r.taken}


def test_shards_draw_different_counts(spark):
    slots = mix(corpus(spark), block_words=2, shard_slots=200).slots
    counts = slots.groupBy("shard", "place").count().collect()
    first = sorted(r["count"] for r in counts if r.place == 0)
    assert len(first) > 5 and first[0] < first[-1]


def test_edges(edge_docs, no_docs):
    rows = taken_words(mix(edge_docs)).collect()
    texts = edge_docs.collect()
    assert sorted((r.id or 0, r.size) for r in rows) == sorted((t.doc_id or 0, len(WORD.findall(t.text or ""))) for t in texts)
    assert all(r.taken <= 3 * r.size for r in rows)
    out = mixed_documents(edge_docs)
    assert out.columns == edge_docs.columns
    inputs = {tuple(t) for t in texts}
    assert all(tuple(r) in inputs and WORD.search(r.text) for r in out.collect())
    assert mixed_documents(no_docs).count() == taken_words(mix(no_docs)).count() == 0
