"""Windows of test items in documents: brute force, offsets, blocks, and odd rows."""

import re

import pytest

from gustgrid.llm import decontam
from gustgrid.llm.decontam import CONTAMINATED, contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, n=13):
    windows = {}
    for ident, text in items:
        words = WORD.findall(lowered(text))
        for i in range(max(1, len(words) - n + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(ident)
    out = []
    for ident, text in docs:
        words, hit, found = WORD.findall(lowered(text)), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (w := tuple(words[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= {str(x) for x in windows[w] if x is not None}
        out.append((ident, len(words), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


LONG = " ".join(f"q{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "Short ITEM, of five words"), (10, LONG), (3, ""), (4, None), (None, "no id but words here"), (5, "né Größe x"), (6, "...")]
DOCS = [(1, f"intro {LONG} outro " * 3), (2, "a short-item of FIVE words; short item of five words"), (3, None), (4, ""), (5, "x né größe X NÉ GRÖSSE x"),
        (6, " ".join(f"q{i}" for i in range(5, 17))), (7, "shortitem of five words"), (None, LONG), (7, LONG.upper()), (8, "no id! but? words-here " + "z " * 400), (9, "né Größe x")]


@pytest.mark.parametrize("block", [500_000, 3])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_PATTERNS", block)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in DOCS], "doc_id long, text string, _items string").repartition(3)
    got = contamination(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r._n_words, r._n_hit, tuple(r["_items"])) for r in got), key=str) == brute(DOCS, ITEMS)


def test_offsets_and_rule(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    rows = {r.doc_id: r for r in contamination(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).selectExpr("*", f"{CONTAMINATED} AS bad").collect()}
    r = rows[2]
    assert [DOCS[1][1][a:b] for a, b in zip(r._spans[::2], r._spans[1::2])] == ["short-item of FIVE words; short item of five words"]
    assert rows[8]._n_hit == 5 and not rows[8].bad and rows[9].bad and not rows[4].bad


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contamination(docs.limit(0), items).collect() == []
    assert {r._n_hit for r in contamination(docs, items.limit(0)).collect()} == {0}
