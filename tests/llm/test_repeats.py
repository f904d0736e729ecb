from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import repeats
from tidemark.llm.repeats import equal_strings, may_repeat, remove_repeats


def brute(rows, length):
    """In the order of ids: what is left, and how much went."""
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            string = data[i : i + length]
            if string in seen:
                gone[i : i + length] = True
            seen.add(string)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((key, len(data), int(gone.sum()), len(edges) // 2, np.frombuffer(data, "u1")[~gone].tobytes()))
    return out


@pytest.mark.parametrize("symbols", [2, 5, 30])
@pytest.mark.parametrize("depth", [7, 8, 20])
def test_equal_strings_are_found_by_extension(symbols, depth):
    draw = np.random.default_rng(symbols)
    x = np.append(draw.integers(1, symbols + 1, 900), 0).astype("i2")
    x[500:560] = x[100:160]
    order, equal = equal_strings(x, depth)
    strings = [tuple(x[i : i + depth].tolist()) for i in order]
    assert strings == sorted(strings)
    assert [e for e, s in zip(equal, strings, strict=True) if len(s) == depth] == [i > 0 and s == strings[i - 1] for i, s in enumerate(strings) if len(s) == depth]


def corpus(seed):
    draw = random.Random(seed)
    words = ["ab", "ba", "é", "lorem", "ipsum", "x"]

    def text(n):
        return " ".join(draw.choice(words) + str(draw.randrange(50)) for _ in range(n))

    passage, rows = text(40), []
    for _ in range(40):
        middle = passage[draw.randrange(30) : 150 + draw.randrange(60)] if draw.random() < 0.7 else ""
        rows.append(text(draw.randrange(30)) + middle + text(draw.randrange(30)))
    rows += ["a" * 350, "ab" * 200, rows[3], "", None, "short"]
    draw.shuffle(rows)
    return list(zip(range(len(rows)), rows, strict=True))


@pytest.mark.parametrize("most", [2, 512])
def test_bytes_that_go_are_those_of_a_plain_scan(spark, most, monkeypatch):
    monkeypatch.setattr(repeats, "MOST_SEGMENTS", most)
    rows = corpus(most)
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()}
    assert [got[r[0]] for r in brute(rows, 100)] == brute(rows, 100)


def test_edges(edge_docs, no_docs):
    rows = edge_docs.select("doc_id", "text").distinct().collect()
    got = remove_repeats(edge_docs).collect()
    assert len(got) == edge_docs.count()
    want = {r[0]: r for r in brute([tuple(r) for r in rows], 100)}
    for r in got:
        assert (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id]
        assert sum(b - a for a, b in r.spans) == r.n_removed
    assert remove_repeats(no_docs).count() == 0
    with pytest.raises(ValueError, match="length"):
        remove_repeats(no_docs, length=30)


def test_segments_left_out_hold_nothing_repeated():
    draw = random.Random(5)
    rows = [bytes(draw.choice(b"abc") for _ in range(draw.randrange(20, 60))) for _ in range(300)]
    rows += [rows[3][:25] + b"x" + rows[7][5:30], b"short", b"z" * 21, b"y" * 20]
    anchors = np.array([draw.randrange(3) for _ in rows], "i8")
    found = may_repeat(np.frombuffer(b"".join(rows), "u1"), np.array([len(r) for r in rows]), anchors, 20)
    strings = [[(a, r[i : i + 20]) for i in range(len(r) - 19)] for a, r in zip(anchors.tolist(), rows, strict=True)]
    times = Counter(s for own in strings for s in own)
    assert found.tolist() == [any(times[s] > 1 for s in own) for own in strings]
    assert 0 < found.sum() < len(rows)


def test_an_anchor_with_very_many_segments(spark):
    draw = random.Random(11)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(130))
    rows = [(i, f"{draw.getrandbits(200):x} {passage}{draw.getrandbits(200):x}") for i in range(700)]
    got = {r.doc_id: (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[r[0]] for r in brute(rows, 100)] == brute(rows, 100)
