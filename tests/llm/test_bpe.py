"""Byte-level BPE against the public library of the same vocabulary, and exact round trips."""

import base64
import hashlib
import random
import struct
import sys

import public_tokenizers
import pytest
import tiktoken

from areastats.llm import bpe, queries

SF_DIR = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def public():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return bpe.Encoder(f.read(), PATTERN)


def ids_of(encoder, text):
    packed = encoder.encode(text)
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def made_texts():
    rng = random.Random(11)
    letters = "abcdeéßñ漢字かなЖя" + "ab" * 6
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(200)]
    texts += [rng.choice("axé=- \n0") * rng.randint(1, 3000) for _ in range(60)]
    texts += ["".join(rng.choice(["ab", "abc", "ba", "cab"]) for _ in range(rng.randint(1, 900))) for _ in range(60)]
    texts += ["<|endoftext|> <|endofprompt|>", "don't I'LL we've  \t\n x", "\x1c\x1d\x85  　 a", "", " ", "\u0000", "🙂" * 999, "👩‍👩‍👧‍👦 ﷽", "ﬀ٣四½Ⅷ"]
    return texts


def test_against_the_public_library(encoder, public):
    for text in made_texts():
        assert ids_of(encoder, text) == public.encode_ordinary(text), text[:60]


def test_every_code_point(encoder, public):
    for low in range(0, sys.maxunicode + 1, 512):
        for gap in ("", "a", " "):
            text = gap.join(chr(c) for c in range(low, low + 512) if not 0xD800 <= c < 0xE000)
            assert ids_of(encoder, text) == public.encode_ordinary(text), (hex(low), gap)


def test_joins_at_every_place(encoder):
    rng = random.Random(4)
    for _ in range(150):
        data = "".join(rng.choice("abé ") for _ in range(rng.randint(2, 60))).encode()
        whole = encoder.merged(data)
        for cut in range(len(data) + 1):
            assert encoder.joined(encoder.merged(data[:cut]), encoder.merged(data[cut:])) == whole


def test_long_words(encoder, public):
    rng = random.Random(8)
    for text in ("a" * 50_001, "ab" * 20_000, "".join(rng.choice("abcdefgh") for _ in range(50_000))):
        assert ids_of(encoder, text) == public.encode_ordinary(text)


def test_query_against_the_public_library(spark, public):
    found = {r.doc_id: r for r in queries.QUERIES["op12_byte_bpe"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for doc_id, text in docs:
        ids = public.encode_ordinary(text or "")
        assert found[doc_id].n_tokens == len(ids)
        assert found[doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert found[doc_id].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "some words"), (3, "x" * 300_000), (4, "same é"), (4, "same é")]
    docs = spark.createDataFrame([(*r, b"1", "d") for r in rows], "doc_id long, text string, ids binary, decoded string")
    found = bpe.decoded(bpe.encoded(docs, PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted(((r.doc_id, r.decoded.decode()) for r in found), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert all(bytes(r.ids) == b"" for r in found if r.doc_id in (1, 2))
    assert bpe.digest(bpe.decoded(bpe.encoded(docs.limit(0), PATH, PATTERN), PATH, PATTERN)).collect() == []
    broken = spark.createDataFrame([(1, None), (2, struct.pack("<I", 60_000)), (3, b"abc"), (4, b"")], "doc_id long, ids binary")
    assert {r.doc_id: r.decoded for r in bpe.decoded(broken, PATH, PATTERN).collect()} == {1: None, 2: None, 3: None, 4: b""}


def test_incomplete_vocabulary():
    with pytest.raises(ValueError, match="single bytes"):
        bpe.Encoder(b"YQ== 0\n", PATTERN)


def test_pieces_that_come_back_are_not_encoded_again(encoder, public, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    made = []
    monkeypatch.setattr(encoder, "piece", lambda data, piece=encoder.piece: made.append(data) or piece(data))
    encoder.packed = bpe.Pieces(encoder)
    text = " ".join(f"again w{chr(97 + i // 26)}{chr(97 + i % 26)}q" for i in range(600))
    assert ids_of(encoder, text) == public.encode_ordinary(text)
    assert made.count(b" again") == 1 and len(encoder.packed) <= 50 and len(encoder.packed.older) <= 50


def test_scans_equal_the_heap(encoder, monkeypatch):
    rng = random.Random(8)
    datas = [bytes(rng.choice(b"ab cdeint\xc3\xa9") for _ in range(rng.randint(0, 24))) for _ in range(3000)]
    scanned = [encoder.merged(d) for d in datas]
    monkeypatch.setattr(bpe, "LEAF", -1)
    assert scanned == [encoder.merged(d) for d in datas]
