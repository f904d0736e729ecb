from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tidemark.llm.pieces import CharMap, Pieces, decode, encode, public_model

PARTS = ["a", "b", "the", " ", "  ", "\n", " \n", "é", "ß", "漢", "😀", "\t", "\r", "<s>", "<0x0A>", "xxxxx", "=", "ing", "́", "​", "\x00", "▁", "　"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=public_model())


def texts():
    draw = random.Random(4)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randrange(30))) for _ in range(600)] + [
        "", " ", "\n\n", "x" * 3000, "ab" * 700, " " * 99, "\na", "a ", " a",
    ]


def test_ids_spans_and_decoding_are_the_librarys(library):
    pieces = Pieces(public_model(), most_chunks=200)
    for text, (ids, spans) in zip(texts(), pieces.encode(texts()), strict=True):
        proto = library.encode(text, return_type="proto")
        assert ids.tolist() == [1, *(p.id for p in proto.pieces), 2]
        assert spans[1:-1].tolist() == [[p.begin, p.end] for p in proto.pieces]
        assert pieces.decode(ids) == library.decode(ids.tolist())


def test_any_ids_decode_as_in_the_library(library):
    pieces, draw = Pieces(public_model()), random.Random(5)
    for _ in range(500):
        ids = [draw.choice([0, 1, 2, 68, 203, 231, 29871, draw.randrange(32000), draw.randrange(3, 259)]) for _ in range(draw.randrange(12))]
        assert pieces.decode(np.array(ids, "u4")) == library.decode(ids)


@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_character_maps_are_the_librarys(rule, squeeze):
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    blob = sentencepiece_model_pb2.ModelProto.FromString(made.serialized_model_proto()).normalizer_spec.precompiled_charsmap
    proto = sentencepiece_model_pb2.ModelProto.FromString(public_model())
    proto.normalizer_spec.precompiled_charsmap = blob
    proto.normalizer_spec.remove_extra_whitespaces = squeeze
    model = proto.SerializeToString()
    library, pieces = sentencepiece.SentencePieceProcessor(model_proto=model), Pieces(model)
    for text in [*texts(), "ﬁne ① Ⅷ ｶﾞ é ＡＢＣ", "  two   spaces  ", "Ⅷ" * 50]:
        ((ids, spans),) = pieces.encode([text])
        proto = library.encode(text, return_type="proto")
        assert ids[1:-1].tolist() == [p.id for p in proto.pieces], text
        assert spans[1:-1].tolist() == [[p.begin, p.end] for p in proto.pieces], text
    assert CharMap(blob).longest("ﬁ".encode(), 0) == ("fi", 3)


def test_frames(edge_docs, no_docs, library):
    rows = encode(edge_docs, public_model(), decode=True).collect()
    source = sorted((r.doc_id or 0, r.text or "") for r in edge_docs.collect())
    got = sorted((r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in rows)
    want = sorted((i, [1, *library.encode(t), 2], library.decode([1, *library.encode(t), 2])) for i, t in source)
    assert got == want
    for r in rows:
        assert len(r.spans) == 2 * len(r.ids)
    decoded = decode(encode(edge_docs, public_model()), public_model()).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in decoded) == [(i, d) for i, _, d in want]
    assert encode(no_docs, public_model()).count() == 0


def test_other_models_are_refused():
    proto = sentencepiece_model_pb2.ModelProto.FromString(public_model())
    proto.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="BPE"):
        Pieces(proto.SerializeToString())
