from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.fill_middle import fill_middle, restore, rotate, token_ends, transformed, untransformed

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def plain_version(key, text, rate=50, spm_rate=80):
    """The same by joining strings."""
    t = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(t), "plain", None, None, text
    a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    p, m, s = "".join(t[:a]), "".join(t[a:b]), "".join(t[b:])
    if h[3] % 100 < spm_rate:
        return len(t), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(t), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@given(st.binary(max_size=60), st.integers(0, 60), st.integers(0, 60), st.integers(0, 60))
def test_a_rotation_exchanges_two_blocks(data, a, b, c):
    low, mid, high = sorted(min(x, len(data)) for x in (a, b, c))
    buffer = bytearray(data)
    rotate(buffer, low, mid, high)
    assert buffer == data[:low] + data[mid:high] + data[low:mid] + data[high:]


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab <PSM>\n\t\x0bé漢😀  ")), st.integers(0, 10**6), st.sampled_from([0, 50, 100]), st.sampled_from([0, 80, 100]))
def test_any_text_is_as_joined_strings_and_comes_back(text, key, rate, spm_rate):
    assert len(token_ends(text.encode())) == len(TOKEN.findall(text))
    got = transformed(text.encode(), str(key), 42, rate, spm_rate)
    assert (*got[:4], got[4].decode()) == plain_version(key, text, rate, spm_rate)
    assert untransformed(got[4], got[1]) == text.encode()


def test_edges_match_the_plain_version(edge_docs):
    rows = edge_docs.collect()
    got = fill_middle(edge_docs, rate=100)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    expected = [(r.doc_id, *plain_version("" if r.doc_id is None else r.doc_id, r.text or "", 100)) for r in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    back = restore(got)
    assert back.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "restored"]
    assert sorted((r.doc_id or 0, r.restored) for r in back.collect()) == sorted((r.doc_id or 0, r.text or "") for r in rows)


def test_no_rows_and_what_is_no_output(spark, no_docs):
    assert fill_middle(no_docs).count() == restore(fill_middle(no_docs)).count() == 0
    odd = spark.createDataFrame([(None, "psm"), ("x", None)], "output string, form string")
    assert [r.restored for r in restore(odd).collect()] == [None, None]
    for output, form in ((b"no sentinels here", "psm"), (b"none", "spm"), (b"x", "other")):
        with pytest.raises(ValueError):
            untransformed(output, form)
