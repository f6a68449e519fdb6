"""Prefix encoding against the tokenizers library, and its parts against plain merging."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gustgrid.llm.prefix_bpe import PrefixBpe, bpe_decode, bpe_encode
from gustgrid.llm.queries import QUERIES, TOKENIZER

ODD = ["", " ", "\n", "a", " a", "a ", "a\n", "\na", "a  b", "a \n b", "it's o'clock 's x'LL 'll", "tab\tstop", "x y　z", "a\x1cb c\x85d", "᠎ x",
       "<|endoftext|> in a <|endoftext|><|endoftext|> text", "<|endoftext", "né à 12 345!! ## ½Ⅷ٣", "日本 語\n\n日本", "a b" * 3000, "a" * 5000, " " * 700, "é é",
       "'s 'll", "a\r\nb", "...\n- x", "👩‍👩‍👧 ok", "\x00\x7f﻿", "ABabAB" * 400, "=" * 333, "ﬁ ǅ ʰ ª"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def model():
    return PrefixBpe(TOKENIZER)


def random_texts(n, seed):
    rng = random.Random(seed)
    parts = ["a", "é", " ", "\n", "'s", "1", "!", "the", "\t", "ß", "AB", "<|endoftext|>", "ing", "zz", "日", " ", "_", "=="]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_ids_and_texts_equal_the_library(model, library):
    for text in ODD + random_texts(4000, 8):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(model.encode(text), "<u4").tolist() == ids, repr(text)
        assert model.decode(model.encode(text)) == library.decode(ids, skip_special_tokens=False) == text


def test_random_letters_equal_the_library(model, library):
    rng = random.Random(2)
    texts = ["".join(rng.choice("etaoinshrdlucmfwypvbgkqjxz") for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice("aab") for _ in range(rng.randrange(1, 80))) for _ in range(500)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(model.encode(text), "<u4").tolist() == want.ids, text


def test_every_character_class(model, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 61 == 0)]
    texts = [f"a{chr(c)}b 1{chr(c)}2 .{chr(c)}. " for c in points]
    for c, text, want in zip(points, texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(model.encode(text), "<u4").tolist() == want.ids, hex(c)


def test_partial_ids_decode_as_the_library(model, library):
    rng = random.Random(5)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(1, 9))]
        assert model.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)
    assert model.decode(np.array([64, 4_000_000_000], "<u4").tobytes()) == "a" and model.decode(None) == ""


def test_pair_test_against_merging(model):
    """Two usable tokens fit exactly if merging their joint bytes by rank gives the two again."""
    def merged(data):
        ids = [by_byte[b] for b in data]
        while True:
            ranks = [(model.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(ids, ids[1:]))]
            if not ranks or min(ranks)[0] == 1 << 60:
                return ids
            _, i = min(ranks)
            ids[i : i + 2] = [whole[model.bytes_of[ids[i]] + model.bytes_of[ids[i + 1]]]]

    whole = {v: k for k, v in model.bytes_of.items() if k not in model.added.values()}
    by_byte = {v[0]: k for v, k in whole.items() if len(v) == 1}
    rng = random.Random(9)
    usable = [t for t in rng.sample(sorted(whole.values()), 3000) if merged(model.bytes_of[t]) == [t]]
    for _ in range(3000):
        a, b = rng.choice(usable), rng.choice(usable)
        assert model.fits(a, b) == (merged(model.bytes_of[a] + model.bytes_of[b]) == [a, b])


def test_forgetting_changes_nothing(library, monkeypatch):
    import gustgrid.llm.prefix_bpe as module

    monkeypatch.setattr(module, "REMEMBERED_BYTES", 2000)
    small = PrefixBpe(TOKENIZER)
    for text in random_texts(300, 4):
        assert np.frombuffer(small.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_frames_with_nulls_repeats_and_clashing_names(spark):
    rows = [(1, "a b"), (None, "x"), (1, "a b"), (2, None), (3, ""), (4, "long words " * 20000)]
    df = spark.createDataFrame([(i, t, 5, "y") for i, t in rows], "doc_id long, text string, ids int, decoded string")
    out = bpe_decode(bpe_encode(df, TOKENIZER), TOKENIZER)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    got = sorted(((r.doc_id, r.text, r.decoded) for r in out.collect()), key=str)
    assert got == sorted(((i, t, t or "") for i, t in rows), key=str)
    assert bpe_decode(bpe_encode(df.filter("false"), TOKENIZER), TOKENIZER).count() == 0


def test_query(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op12_prefix_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert public_tokenizers.path("byte_bpe_50k.json") == TOKENIZER
