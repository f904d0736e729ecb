from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tidemark.llm.exact_dedup import deduplicate, exact_groups


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edges_match_a_plain_count(edge_docs):
    got = sorted((tuple(r) for r in exact_groups(edge_docs).collect()), key=repr)
    assert got == expected([(r.doc_id, r.text) for r in edge_docs.collect()])


def test_texts_that_share_a_digest_are_told_apart(edge_docs):
    def one_digest(text):
        return F.when(text.isNotNull(), F.lit(b"same"))

    got = sorted((tuple(r) for r in exact_groups(edge_docs, salts=2, digest=one_digest).collect()), key=repr)
    assert got == expected([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert deduplicate(edge_docs, digest=one_digest).count() == deduplicate(edge_docs).count()


def test_rows_travel_with_the_largest_id(edge_docs):
    got = deduplicate(edge_docs)
    assert got.columns == edge_docs.columns
    rows = edge_docs.collect()
    kept = {(r.text or ""): r for r in got.collect()}
    assert len(kept) == got.count() == len({r.text or "" for r in rows})
    assert kept[""].doc_id == 12 and kept[""].text is None
    assert kept["one"].asDict() == next(r for r in rows if r.text == "one").asDict()


def test_no_rows(no_docs):
    assert exact_groups(no_docs).count() == deduplicate(no_docs).count() == 0
