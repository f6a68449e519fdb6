"""Token files: exact round trips against the tokenizers library."""

import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gustgrid.llm.queries import QUERIES, TOKENIZER
from gustgrid.llm.token_dac import Encoder, dac_decode, dac_encode, dac_get, read_documents, tokens_at, write_tokens
from gustgrid.session import shared_dir

ODD = ["", " ", "\n", "a", " a", "a ", "a\n", "\na", "a  b", "a \n b", "it's o'clock 's x'", "tab\tstop", "x y z", "a\x1cb c\x85d",
       "<|endoftext|> in a text", "né à 12 345!! ##", "日本 語\n\n日本", "a b" * 3000, "᠎ x", "é é", "'s 'll", "1 2 3", "a\r\nb", "...\n- x"]


def test_dac_levels_and_random_access():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(1, np.uint32), rng.integers(0, 2**32, 3000, dtype=np.uint32), rng.integers(0, 300, 5000).astype(np.uint32), np.arange(70000, dtype=np.uint32)):
        levels, bitmaps, ranks = dac_encode(ids)
        assert (dac_decode(levels, bitmaps) == ids).all()
        assert all(dac_get(levels, bitmaps, ranks, i) == ids[i] for i in [0, len(ids) - 1, *rng.integers(0, len(ids), 300).tolist()])


def test_encoder_equals_the_library():
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice(["a", "é", " ", "\n", "'s", "1", "!", "the", "\t", "ß", "AB", "<|endoftext|>"]) for _ in range(rng.randrange(40))) for _ in range(3000)]
    got = Encoder(TOKENIZER).encode(texts + [None])
    for text, ids in zip(texts + [""], got):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def library_rows(rows):
    whole, start, out = Tokenizer.from_file(TOKENIZER), 0, []
    for ident, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((ident, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out, start


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect())
    got = sorted(tuple(r) for r in QUERIES["op9_directly_addressable_tokens"](spark, f"/root/testdata/{sf}").collect())
    assert got == library_rows(rows)[0]


def test_nulls_repeats_and_access(spark):
    rows = [(2, "b c"), (None, "null id"), (2, "b c"), (1, None), (3, ""), (9, "long " * 5000)]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, start int, id string")
    out = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(df, out, TOKENIZER)
    order = [(None, "null id"), (1, None), (2, "b c"), (2, "b c"), (3, ""), (9, "long " * 5000)]
    want, total = library_rows(order)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r) for r in read_documents(spark, out).collect()), key=key) == sorted(want, key=key)
    whole = Tokenizer.from_file(TOKENIZER)
    flat = [i for _, t in order for i in [*whole.encode(t or "", add_special_tokens=False).ids, 0]]
    asked = spark.createDataFrame([(p,) for p in [0, 1, 5, 7, total - 1, total, 2, 2]], "position long")
    assert {tuple(r) for r in tokens_at(spark, out, asked).collect()} == {(p, flat[p]) for p in [0, 1, 2, 5, 7, total - 1]}


def test_empty_table(spark):
    out = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(spark.createDataFrame([], "doc_id long, text string"), out, TOKENIZER)
    assert read_documents(spark, out).collect() == []


def test_new_pieces_skip_the_split_of_the_library(monkeypatch):
    from tokenizers import Tokenizer

    texts = ["Ωmega naïve\u00a0x\r\n\n  12 don't!", " \t\n", "日本語 \U0001f600 e\u0301", "a" * 300, "\x00\x7f\x80 ~", "plain words plain words"]
    encoder, library = Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    monkeypatch.setattr(encoder, "_library", None)
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
