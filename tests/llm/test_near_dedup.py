from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id, near_dedup
from tidemark.llm.components import components
from tidemark.llm.near_dedup import deduplicate_near, near_duplicates


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        known = [k for k in (least.get(find(i)), key) if k is not None]
        least[find(i)] = min(known) if known else None
    return sorted(((k, len(sets[i]), least[find(i)], k == least[find(i)]) for i, (k, _) in enumerate(rows)), key=repr)


def corpus(seed, copies):
    draw = random.Random(seed)
    vocabulary = [f"Word{i}" for i in range(300)]
    rows, base = [], [draw.choice(vocabulary) for _ in range(120)]
    shared = [draw.choice(vocabulary) for _ in range(90)]
    for i in range(copies):
        words = list(base)
        for _ in range(draw.randrange(5)):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        rows.append(" ".join(words))
    rows += [" ".join(shared + [draw.choice(vocabulary) for _ in range(draw.randrange(10, 60))]) for _ in range(copies)]
    rows += [" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(1, 40))) for _ in range(30)]
    rows += [rows[0], rows[0].upper(), rows[1] + "  \n", "", None]
    draw.shuffle(rows)
    return list(zip(range(10, 10 + len(rows)), rows, strict=True))


@pytest.mark.parametrize("seed,copies", [(1, 12), (2, 60)])
def test_components_are_those_of_all_pairs(spark, seed, copies, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 4)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rows = corpus(seed, copies)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in near_duplicates(docs).collect()), key=repr) == brute(rows)


def test_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert sorted((tuple(r) for r in near_duplicates(edge_docs).collect()), key=repr) == brute(rows)
    kept = deduplicate_near(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 6 in ids and 7 not in ids and 8 not in ids and {1, 2, 3, 12} <= set(ids)
    assert near_duplicates(no_docs).count() == deduplicate_near(no_docs).count() == 0


def test_lower_thresholds_are_refused(edge_docs):
    with pytest.raises(ValueError, match="85"):
        near_duplicates(edge_docs, percent=70)


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 40)], [(i, i * 7 % 53) for i in range(53)], [(3, 3)]])
def test_components(spark, links):
    frame = spark.createDataFrame(links, "a long, b long")
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    want = {x: r for x, r in root.items() if len(links) > 1}
    got = {r.node: r.component for r in components(frame.withColumn("b", F.col("b"))).collect()}
    assert {x: got.get(x, x) for x in want} == want


def test_pairs_from_eighty_percent_on(spark):
    words = [f"w{i}" for i in range(104)]
    near, far = list(words), list(words)
    near[10] = near[60] = "other"  # 90 of 110 shingles
    far[10] = far[40] = far[70] = "other"  # 85 of 115
    rows = [(1, " ".join(words), "en", "s", 1), (2, " ".join(near), "en", "s", 1), (3, " ".join(far).replace("w", "v"), "en", "s", 1), (4, " ".join(words).replace("w", "v"), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert (near_dedup.matches(85), near_dedup.matches(80)) == (28, 24)
    assert {r.doc_id for r in deduplicate_near(docs).collect()} == {1, 2, 3, 4}
    assert {r.doc_id for r in deduplicate_near(docs, percent=80).collect()} == {1, 3, 4}


class Handed:
    """Stands for the table that a function of batches is handed to: gives back the function."""

    def mapInArrow(self, run, schema):
        return run


def most_memory(run):
    run()  # what is kept between batches is there
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 2**20


def test_batches_of_signatures_take_little_memory(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "_hashed", lambda *_: Handed())
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    run = near_dedup.signatures(docs, "doc_id", "text")
    draw = random.Random(5)
    texts = [" ".join(f"w{draw.randrange(5000)}" for _ in range(500)) for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array(texts), pa.array(range(3000))], names=["id", "text", "text_hash"])

    def through():
        for _ in run(iter([batch])):
            pass

    assert most_memory(through) < 48


def test_letters_of_a_batch_take_little_memory():
    texts = [("some words of one language " * 20000)[:500000]]
    counts = language_id._counted(iter([pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(texts)], names=["lang", "text"])]))
    model = language_id.estimate(pa.Table.from_batches(list(counts)).to_pandas())
    assert most_memory(lambda: language_id.entropies(model, texts)) < 48


def test_a_task_counts_the_coordinates_of_few_classes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SHARE", 64)
    counted, kept = [], near_dedup.stored

    def noted(df, purpose):
        counted.extend([df._jdf.queryExecution().toString()] * (purpose == "postings"))
        return kept(df, purpose)

    monkeypatch.setattr(near_dedup, "stored", noted)
    values = np.random.default_rng(3).integers(0, 90, (640, near_dedup.COORDINATES)).tolist()
    classes = spark.createDataFrame(list(enumerate(values)), "node long, minima array<int>")
    posted = near_dedup._posted(classes, 24)
    holders = {}
    for node, row in enumerate(values):
        for at in enumerate(row):
            holders.setdefault(at, []).append(node)
    got = posted.collect()
    assert got and all((r.total, r.hub) == (len(x), min(x)) and r.node in x for r in got for x in [holders[r.place, r.value]])
    assert len(counted) == 1 and re.search(r"RepartitionByExpression \[node#\d+L?\], 11", counted[0])
