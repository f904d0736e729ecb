from __future__ import annotations

import random
import re
from collections import Counter as Tally
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm.phrases import Counter, HatTrie, _distinct, collocations, frequent_bits, pair_bits, phrase_counts

TEXTS = ["The cat, sat on\tthe mat. the CAT sat", "on the mat the cat sat on the mat", "É é the  cat\x0bsat!on the mat\x1c x", "a a a a a b a a", ""]


def grams(rows, most=5):
    found, sizes = Tally(), Tally()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall("[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    found[lang or "und", tuple(w[i : i + k])] += 1
    return found, sizes


def expected(rows, least, most=5, percent=100, top=2000):
    found, sizes = grams(rows, most)
    by_lang = defaultdict(list)
    for (lang, p), a in found.items():
        if len(p) < 2 or a < least:
            continue
        if any(
            m == lang and len(q) > len(p) and b >= least and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (m, q), b in found.items()
        ):
            continue
        cuts = [(1000 * a * sizes[lang] // (found[lang, p[:k]] * found[lang, p[k:]]), k, found[lang, p[:k]], found[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        by_lang[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return {
        (lang, rank, p.decode(), -a, left, right, sizes[lang], -score)
        for lang, own in by_lang.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1)
    }


def made_up(seed, n=60):
    draw = random.Random(seed)
    words = ["a", "b", "é", "the", "of", "x.y", "Zed", "漢"]
    stock = [" ".join(draw.choice(words) for _ in range(12)) for _ in range(4)]
    rows = []
    for _ in range(n):
        parts = [draw.choice(stock) if draw.random() < 0.3 else draw.choice(words) + draw.choice([" ", "  ", "\t", ", ", ".", "\n"]) for _ in range(draw.randrange(30))]
        rows.append((draw.choice(["en", "de", None]), "".join(parts)))
    return rows


@pytest.mark.parametrize(("seed", "least", "percent", "top", "most_entries"), [(1, 3, 100, 2000, 1 << 19), (2, 2, 60, 25, 40), (3, 1, 100, 7, 5)])
def test_phrases_match_a_plain_count(spark, seed, least, percent, top, most_entries):
    rows = made_up(seed) + [("en", t) for t in TEXTS] + [("en", None), ("fr", "")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations(docs, least, inside_percent=percent, top=top, most_entries=most_entries)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == expected(rows, least, percent=percent, top=top)


def test_products_beyond_64_bits_are_exact(spark):
    from tidemark.llm.phrases import _scored

    big = 3_000_000_000_019
    known = [("en", 0, "", 9 * big), ("en", 1, "a", 2 * big + 1), ("en", 1, "b", big + 2), ("en", 2, "a b", big)]
    (row,) = _scored(spark.createDataFrame(known, "lang string, width int, phrase string, n long")).collect()
    assert row.score == 1000 * big * 9 * big // ((2 * big + 1) * (big + 2))


def test_a_trie_bursts_and_writes_out_sorted_subtrees():
    draw = np.random.default_rng(1)
    trie, plain, spilled = HatTrie(burst=6), Tally(), []
    for _ in range(30):
        rows, counts = _distinct(draw.integers(1, 9, (80, 4)).astype(">u4"))
        for row, n in zip(rows.tolist(), counts.tolist(), strict=True):
            plain[tuple(row)] += n
        trie.add(rows, counts)
        if trie.entries > 300:
            runs = list(trie.spill(150))
            keys = [k for k, _ in runs]
            assert trie.entries <= 150 and keys == sorted(keys)
            left = {first for first in trie.root}
            assert not left & {int.from_bytes(k[:4], "big") for k in keys}  # whole subtrees
            spilled += runs
    spilled += trie.spill(0)
    assert not trie.root and trie.entries == 0
    merged = Tally()
    for key, n in spilled:
        merged[tuple(np.frombuffer(key, ">u4").tolist())] += n
    assert merged == plain


def test_a_task_is_bounded_with_very_many_words():
    counter = Counter("en", range(1, 2), None, None, most=50)
    got = Tally()

    def take(batches):
        for batch in batches:
            for key, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got[key] += n

    for i in range(40):
        take(counter.count([" ".join(f"w{i * 20 + j}" for j in range(30))]))
        assert len(counter.words) <= 51 + 30 and counter.tries[1].entries <= 80
    take(counter.spill(0))
    assert got["en\n"] == 1200 and got["en\nw25"] == 2 and got["en\nw5"] == 1 and len(got) == 811


def test_the_map_of_frequent_phrases_loses_none(spark):
    rows = made_up(5, 200)
    docs = spark.createDataFrame(rows, "lang string, text string")
    plain, _ = grams(rows, 3)
    singles = phrase_counts(docs, range(1, 2)).filter("n >= 5 and width = 1")
    words = frequent_bits(spark, singles)
    found = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in singles.collect()}
    for slots in (1 << 16, 1 << 20):
        longer = phrase_counts(docs, range(2, 4), words=words, pairs=pair_bits(docs, 5, words, slots=slots)).filter("n >= 5")
        found |= {(r.lang, tuple(r.phrase.split(" "))): r.n for r in longer.collect()}
    assert found == {k: n for k, n in plain.items() if n >= 5}


def test_edges_and_no_rows(edge_docs, no_docs):
    rows = [(r.lang, r.text) for r in edge_docs.collect()]
    got = {tuple(r) for r in collocations(edge_docs, least=2).collect()}
    assert got == expected(rows, 2)
    assert collocations(no_docs).count() == 0
