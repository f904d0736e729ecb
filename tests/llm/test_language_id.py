from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import language_id
from tidemark.llm.language_id import ORDER, entropies, estimate, fit, predict, recognised, streams, windows

WORDS = {
    "en": "the and of that with from this have which their would about there people into over".split(),
    "de": "der und die nicht mit auf sich auch nach über wenn werden können schön größe".split(),
    "fr": "les des une que dans pour avec être après où leur même très français élève".split(),
}


def text(lang, n, draw):
    return " ".join(draw.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(2)
    rows = [(i, text(lang, draw.randrange(3, 60), draw), lang) for i in range(600) for lang in [list(WORDS)[i % 3]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").cache()


@pytest.fixture(scope="module")
def model(labelled):
    return fit(labelled, per_language=120)


def counted(texts_by_lang):
    import pandas as pd

    rows = {}
    for lang, texts in texts_by_lang.items():
        for back, _ in windows(*streams(texts)):
            for gram in map(tuple, back.T.tolist()):
                rows[(lang, *gram)] = rows.get((lang, *gram), 0) + 1
    return pd.DataFrame([(*k, v) for k, v in rows.items()], columns=["lang", "c0", "c1", "c2", "c3", "n"])


def test_probabilities_sum_to_one():
    counts = counted({"a": ["abc abd ab", "cab"], "b": ["bca bca dd"]})
    model = estimate(counts)
    letters = [*sorted({*counts["c0"]}), ord("Z")]  # Z stands for all that is unseen
    for context in ["ab", "ca", "dd", "abc", "q", "", "bca"]:
        total = sum(np.exp(-letter_score(model, context, c)) for c in letters)
        assert np.allclose(total, 1)


def letter_score(model, prefix, c):
    """Minus log-probability of letter ``c`` behind ``prefix``, by language, read from the tables in the plain way."""
    history = [0] * ORDER + [ord(x) for x in prefix]
    out = np.zeros(len(model.languages))
    for order in range(ORDER, 0, -1):
        gram = [c, *history[::-1][: order - 1]]
        key = sum(g * int(f) for g, f in zip(gram, language_id.FACTORS, strict=False)) % 2**64
        keys, values = model.grams[order - 1]
        at = np.searchsorted(keys, np.uint64(key))
        if at < len(keys) and keys[at] == np.uint64(key):
            return out - values[at]
        key = sum(g * int(f) for g, f in zip(gram[1:], language_id.FACTORS, strict=False)) % 2**64
        keys, values = model.contexts[order - 1]
        at = np.searchsorted(keys, np.uint64(key))
        if at < len(keys) and keys[at] == np.uint64(key):
            out = out - values[at]
    return out - model.floor


def test_text_scores_are_sums_of_letter_scores(model, monkeypatch):
    texts = ["Der und die", "the QX 漢字 people!", "", "x", "une, que -- dans"]
    want = []
    for t in texts:
        code, _ = streams([t])
        letters = [chr(c) if c else "\0" for c in code.tolist()]
        want.append(sum((letter_score(model, "".join(letters[:i]).replace("\0", "\0"), ord(x) if x != "\0" else 0) for i, x in enumerate(letters)), np.zeros(3)))
    for chunk in (1 << 19, 5):
        monkeypatch.setattr(language_id, "CHUNK", chunk)
        h, n = entropies(model, texts)
        assert np.allclose(h * np.maximum(n, 1)[:, None], want)


def test_held_out_texts_get_their_language(labelled, model):
    rows = predict(labelled, model, keep=["lang"]).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)
    assert not any(r.rejected for r in rows) and all(0 <= r.score <= 1 for r in rows)


def test_other_writing_is_rejected(spark, model):
    odd = [(1, "чужой язык совсем другие буквы " * 5), (2, "漢字 " * 50), (3, "123 !! 4"), (4, None), (5, "the people with that")]
    rows = {r.doc_id: r for r in predict(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    assert [rows[i].rejected for i in range(1, 6)] == [True, True, True, True, False]
    assert rows[3].lang_pred == rows[4].lang_pred == "und" and rows[3].score == 0
    assert rows[1].lang_pred in WORDS and rows[5].lang_pred == "en"


def test_edges(edge_docs, no_docs, labelled):
    assert fit(no_docs) is None and predict(no_docs, None).count() == 0 and recognised(no_docs).count() == 0
    rows = predict(edge_docs, None).collect()
    assert len(rows) == edge_docs.count() and {r.lang_pred for r in rows} == {"und"}
    kept = recognised(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r.text for r in kept.collect()} <= {r.text for r in edge_docs.collect() if r.text}
