"""Encoding, spans and decoding against the library."""

from __future__ import annotations

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from fieldkpi.llm import frames, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "ab ▁ \n\t\x00éß日本😀́<s>0x1F  .'１ﬁ�ＡＢＣÅｶﾞ㍿　​"


@pytest.fixture(scope="module")
def model():
    return pieces.load(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def drawn(n: int, longest: int) -> list[str]:
    draw = random.Random(4)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randrange(longest))) for _ in range(n)]


def test_ids_spans_and_decoding_are_those_of_the_library(model, library):
    for value in [*drawn(1500, 30), *drawn(40, 600), "x" * 300, " " * 200, "a b" * 5000]:
        ids, starts, ends = model.encode(value.encode())
        assert ids.tolist() == library.encode(value, add_bos=True, add_eos=True)
        proto = library.encode(value, return_type="proto")
        assert [(p.begin, p.end) for p in proto.pieces] == list(zip(starts[1:-1].tolist(), ends[1:-1].tolist(), strict=True))
        assert model.decode(ids) == library.decode(ids.tolist())


def test_any_ids_are_decoded_like_the_library(model, library):
    draw = random.Random(6)
    for _ in range(800):
        ids = [draw.choice([0, 1, 2, draw.randrange(3, 259), draw.randrange(259, 32000), 29871]) for _ in range(draw.randrange(12))]
        assert model.decode(np.array(ids, np.int64)) == library.decode(ids)


def test_segments_are_merged_together_as_one_by_one(model):
    segments = sorted({"▁" + w for value in drawn(3000, 40) for w in value.split(" ") if w})
    ids, counts = model._spelled(*model._merge_all(segments))
    together = np.split(ids, np.cumsum(counts)[:-1])
    for segment, own in zip(segments, together, strict=True):
        assert own.tolist() == model._segment(segment)
    assert len(model._merge_all([])[0]) == 0


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
def test_compiled_maps_are_followed_with_their_origins(rule):
    """Maps that the library brings along: longest prefixes, replaced, dropped and trimmed, each byte with its origin."""
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = next(v for n, v in pieces._fields(theirs.serialized_model_proto()) if n == 3)
    mine = pieces.Normaliser(spec)
    for value in drawn(1500, 30):
        form, origin = mine(value.encode())
        other, offsets = theirs.Normalize(value, with_offsets=True)
        raw, done = value.encode(), form.encode()
        assert form == other
        at = [0] + [len(form[: i + 1].encode()) for i in range(len(form))]
        assert [len(raw[: origin[b]].decode()) for b in at] == list(offsets), (value, len(done))


def test_malformed_bytes_become_replacement_characters_one_by_one(model, library):
    raw = b"a\xff\xe2\x82b\xed\xa0\x80c"
    ids, starts, ends = model.encode(raw)
    assert model.decode(ids) == "a���b���c"
    assert ids.tolist() == library.encode("a���b���c", add_bos=True, add_eos=True)
    assert ends[-1] == len(raw) and (np.diff(starts.astype(np.int64)) >= 0).all()


def test_documents_of_every_kind(spark, model, library):
    frames.importable(spark)
    rows = [(i, v) for i, v in enumerate(drawn(80, 60))] + [(500, None), (501, ""), (None, "x y"), (None, None), (7, "again"), (7, "again"), (502, "wort " * 40000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("=").alias(c) for c in ("ids", "starts", "piece")])
    wanted = []
    for i, value in rows:
        ids = library.encode(value or "", add_bos=True, add_eos=True)
        wanted.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    order = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r) for r in pieces.digests(docs, model).collect()), key=order) == sorted(wanted, key=order)
    assert pieces.digests(docs.limit(0), model).count() == 0
    value = dict(rows)[3]
    listed = pieces.spans(pieces.encoded(docs.where("doc_id = 3"), model), model).orderBy("at").collect()
    raw = value.encode()
    assert [r.piece for r in listed][1:-1] == library.encode(value, out_type=str)
    assert b"".join(raw[r.start : r.end] for r in listed) == raw
